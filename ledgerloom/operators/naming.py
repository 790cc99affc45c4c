"""Names in folders, given in the order of arrival: whoever comes first keeps a name, later ones get their hash, and a number if need be.

The rule is sequential, its evaluation is not. All rows claim names at once; of a
name's claimants the first by ordinal holds it, and the others go on to the next
name of their own list. Rows whose lists are equal (one name, one hash) never
meet: they start at successive numbers and move together. So only claims on
names that look like generated ones take another round, each round a join.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ledgerloom.operators.joins import join_one
from ledgerloom.operators.ordering import running
from ledgerloom.plans.scratch import written

HASH_LENGTH = 12
#: Names ahead that a claimant looks at in one round.
AHEAD = 16


def split_path(path: Column) -> tuple[Column, Column, Column]:
    """(directory with its slash, stem, extension with its dot); a leading dot begins no extension."""
    name = F.regexp_extract(path, r"([^/]*)$", 1)
    extension = F.regexp_extract(name, r"[^/](\.[^./]*)$", 1)
    return F.regexp_extract(path, r"^(.*/)?[^/]*$", 1), F.substring(name, F.lit(1), F.length(name) - F.length(extension)), extension


def numbered(stem: Column, sha256: Column, n: Column, extension: Column) -> Column:
    """stem__hash12.ext for n = 1, stem__hash12-n.ext beyond."""
    return F.concat(stem, F.lit("__"), F.substring(sha256, 1, HASH_LENGTH), F.when(n > 1, F.concat(F.lit("-"), n.cast("string"))).otherwise(F.lit("")), extension)


def _name(path: Column, level: Column) -> Column:
    """The name of a level: the path itself at 0."""
    directory, stem, extension = split_path(path)
    return F.when(level == 0, path).otherwise(numbered(F.concat(directory, stem), F.col("sha256"), level, extension))


def assign_destinations(rows: DataFrame, wanted: str = "wanted_path", ordinal: str = "ordinal", taken: DataFrame | None = None) -> DataFrame:
    """``rows`` (wanted_path, sha256, ordinal; ordinals differ) with destination_path; names are compared without case.

    ``taken`` (path) holds names that exist already. All of it are joins and range sorts: neither a folder nor a name nor a content is settled in one task.
    """
    path, order = F.col(wanted), F.col(ordinal)
    own = rows.select(order.alias("__ordinal"), path.alias("__path"), "sha256").withColumns({"__low": F.lower("__path"), "__mark": F.substring("sha256", 1, HASH_LENGTH)})
    held = None if taken is None else written(taken.select(F.lower("path").alias("__claim")).distinct(), "taken")
    firsts = own.groupBy("__low").agg(F.min("__ordinal").alias("__ordinal"))
    if held is not None:
        firsts = firsts.join(held.withColumnRenamed("__claim", "__low"), "__low", "left_anti")
    # The first of a name keeps it; the others of one name and hash are numbered in order.
    free = own.join(firsts.select("__low", "__ordinal", F.lit(1).alias("__keeps")), ["__low", "__ordinal"], "left")
    state = running(written(free, "names"), ["__low", "__mark"], [F.col("__ordinal")], 1 - F.coalesce("__keeps", F.lit(0)), "__level").drop("__keeps")
    while True:
        claims = written(state.withColumn("__claim", F.lower(_name(F.col("__path"), F.col("__level")))), "claims")
        holders = claims.groupBy("__claim").agg(F.min("__ordinal").alias("__holder"), F.count(F.lit(1)).alias("__n"))
        lost = claims.join(holders.filter("__n > 1"), "__claim").filter("__ordinal > __holder").drop("__holder", "__n")
        if held is not None:
            lost = lost.unionByName(claims.join(held, "__claim", "left_semi")).dropDuplicates(["__ordinal"])
        lost = written(lost, "lost")
        if not lost.take(1):
            break
        # On to the next name that nobody before holds; who holds it may still come to lose it, but only to one who comes before, too.
        ahead = lost.withColumn("__next", F.explode(F.sequence(F.col("__level") + 1, F.col("__level") + AHEAD)))
        ahead = ahead.withColumn("__claim", F.lower(_name(F.col("__path"), F.col("__next")))).join(holders.select("__claim", "__holder"), "__claim", "left")
        blocked = F.coalesce(F.col("__holder") < F.col("__ordinal"), F.lit(False))
        if held is not None:
            ahead = ahead.join(held.withColumn("__held", F.lit(True)), "__claim", "left")
            blocked = blocked | F.coalesce("__held", F.lit(False))
        moved = ahead.groupBy("__ordinal").agg(F.coalesce(F.min(F.when(~blocked, F.col("__next"))), F.max("__next") + 1).alias("__next"))
        # Those behind with the same list keep their distance, so that they stay in order.
        state = claims.drop("__claim").join(moved, "__ordinal", "left").withColumn("__level", F.coalesce("__next", "__level")).drop("__next")
        touched = lost.select("__low", "__mark").distinct()
        still, state = state.join(touched, ["__low", "__mark"], "left_anti"), state.join(touched, ["__low", "__mark"], "left_semi")
        state = running(state, ["__low", "__mark"], [F.col("__ordinal")], F.lit(1), "__rank")
        state = running(state, ["__low", "__mark"], [F.col("__ordinal")], F.col("__level") - F.col("__rank"), "__lead", how="max").withColumn("__level", F.col("__lead") + F.col("__rank")).drop("__lead", "__rank")
        state = still.unionByName(state)
    named = claims.select(F.col("__ordinal").alias(ordinal), _name(F.col("__path"), F.col("__level")).alias("destination_path"))
    return rows.join(named, ordinal).select(*rows.columns, "destination_path")


def collect_versions(rows: DataFrame, name: str = "file_name", ordinal: str = "ordinal") -> DataFrame:
    """For files of several sources that go into one folder, in the order of ``ordinal``: status and target_name.

    A file takes its name if it is free. Where other content has it, ``stem__hash12`` follows, then ``stem__hash12-2`` and so on; where equal
    content has it, there or on the way, the file is skipped. Files that lie in the folder already come as rows with the first ordinals. Names are compared without case.

    Rows of one name and content are one claimant. A name can be claimed by natural owners, and by the versions of one other name and hash: these look
    from number to number until none blocks them, and what they take from natural owners is made known to the next round, until nothing changes. A natural name that looks
    like a version of a version needs one round more for each such step.
    """
    claimants = rows.withColumn("__low", F.lower(name)).groupBy("__low", "sha256").agg(F.min(ordinal).alias("first"), F.min_by(name, ordinal).alias("name"), F.count(F.lit(1)).alias("copies"))
    claimants = written(claimants, "claimants")
    natural = written(claimants.groupBy("__low").agg(F.min(F.struct("first", "sha256")).alias("owner"), F.count(F.lit(1)).alias("members")).select("__low", "owner.*", "members"), "owners")
    taken, known = None, None
    while True:
        owners = natural.select("__low", F.struct("first", "sha256").alias("owner"), "members")
        if taken is not None:
            owners = owners.join(taken.select("__low", F.struct("first", "sha256").alias("other")), "__low", "left").select("__low", F.coalesce("other", "owner").alias("owner"), "members")
            owners = written(owners, "owners")
        placed = join_one(claimants, owners, ["__low"]).withColumn("home", F.col("sha256") == F.col("owner.sha256"))
        home = placed.filter("home").select("__low", "sha256", F.lit(0).alias("level"), (F.col("first") == F.col("owner.first")).alias("made"))
        waiting, settled, level = written(placed.filter("not home").select("__low", "sha256", "first", "name"), "versions"), [], 1
        while waiting.take(1):
            claim = waiting.withColumn("claim", F.lower(_name(F.col("name"), F.lit(level))))
            # Natural owners of the name, and versions of one hash prefix that differ behind it.
            mates = claim.groupBy("claim").agg(F.min(F.struct("first", "sha256")).alias("mate"))
            claim = claim.join(mates, "claim").join(natural.select(F.col("__low").alias("claim"), F.struct("first", "sha256").alias("natural")), "claim", "left")
            claim = written(claim.withColumn("holder", F.least("mate", "natural")), "claims")
            stays = F.col("holder.sha256") == F.col("sha256")
            settled.append(claim.filter(stays).select("__low", "sha256", F.lit(level).alias("level"), (F.col("holder.first") == F.col("first")).alias("made"), "claim", "first", F.col("natural").isNotNull().alias("contested")))
            waiting, level = claim.filter(~stays).select("__low", "sha256", "first", "name"), level + 1
        if not settled:
            versions = home.limit(0)
            break
        every = settled[0]
        for s in settled[1:]:
            every = every.unionByName(s)
        every = written(every, "settled")
        versions = every.select("__low", "sha256", "level", "made")
        taken = written(every.filter("made and contested").select(F.col("claim").alias("__low"), "first", "sha256"), "taken")
        now = taken.agg(F.count(F.lit(1)), F.sum(F.xxhash64("__low", "first", "sha256").cast("decimal(38,0)"))).first()
        if now[0] == 0 or now == known:
            break
        known = now
    places = written(claimants.join(home.unionByName(versions), ["__low", "sha256"]).select("__low", "sha256", "first", "level", "made", F.col("copies").alias("members")), "places")
    joined = join_one(written(rows.withColumn("__low", F.lower(name)), "files"), places, ["__low", "sha256"])
    made = F.col("made") & (F.col("first") == F.col(ordinal))
    status = F.when(~made, "skipped_identical").when(F.col("level") == 0, "copied").otherwise("copied_version")
    return joined.select(*rows.columns, status.alias("status"), _name(F.col(name), F.col("level")).alias("target_name"))

