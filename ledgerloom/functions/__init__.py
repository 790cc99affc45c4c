"""Part of ledgerloom."""
