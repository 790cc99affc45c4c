"""Document fingerprints by SpotSigs, in DataFrame functions only.

Wherever an anchor (a very common word) stands before a content word, that word
and the next content words, common words skipped, form a chain. The hashes of
its chains are a document's signatures; two documents are as alike as the
Jaccard similarity of their sets of signatures. Classes of equal sets are
partitioned by length and compared by their rarest signatures.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ledgerloom.llm.common import join_one, materialise, text_of

#: Content words in a chain.
CHAIN = 3
#: A text with fewer anchored chains has the chains of all its content words.
FEW = 4
#: Bytes of text in a bucket of neighbours; in larger tables buckets are larger, so that there are ``MAX_BUCKETS`` at most, about, each of ``CELLS`` cells.
BUCKET_BYTES, MAX_BUCKETS, CELLS = 24 << 20, 50_000, 4
#: Classes with one signature that are compared in one block.
BLOCK = 2048
# Articles, forms of "to be" and the like start chains; all common words are skipped within them.
ANCHORS = "a an the is was are that there le la les un une est des der die das ein eine ist el los las una".split()
COMMON = (
    ANCHORS
    + "and of to in it for on with as by at from this be he she they we you or not but have has had were will would can which what".split()
    + "de du et en au aux que qui dans pour par sur pas ne se ce il elle sont avec ou".split()
    + "und zu den dem von mit auf für nicht auch sich im am als wie bei oder sind war er sie wir ihr".split()
    + "del y es que con por para su se no lo como más o al era son este esta".split()
)


def with_signatures(rows: DataFrame, text: str, out: str) -> DataFrame:
    """``rows`` with ``out``: sorted, distinct 32-bit hashes of the chains of a text column without nulls. With fewer than ``FEW`` anchored chains, chains begin at every content word; a text without any chain has the hash of itself in lower case.

    Words are numbers from the first step on: 0 for a common word, 1 for an anchor, else a hash with bit 1 set; bit 0 then marks those that follow an anchor.
    Each step is a column of its own, so that none is computed twice.
    """
    zero = F.lit(0).cast("long")
    coded = lambda w: F.when(w.isin([*COMMON, ""]), F.when(w.isin(ANCHORS), F.lit(1).cast("long")).otherwise(zero)).otherwise(F.shiftleft(F.xxhash64(w), 2).bitwiseOR(F.lit(2).cast("long")))
    rows = rows.withColumn("__words", F.transform(F.split(F.lower(text), r"[^\p{L}\p{N}]+"), coded))
    follows = lambda w, p: F.when((w != 0) & (w != 1), F.when(p == 1, w.bitwiseOR(F.lit(1).cast("long"))).otherwise(w))
    # The place past the last word is null and goes with the common words.
    rows = rows.withColumn("__content", F.filter(F.zip_with("__words", F.concat(F.array(zero), "__words"), follows), lambda w: w.isNotNull()))
    bare = lambda w: F.shiftrightunsigned(w, 2)
    # Several anchors in a row lead to one chain, so anchors are no part of it.
    after = F.zip_with(F.slice("__content", 2, 1 << 30), F.slice("__content", 3, 1 << 30), lambda x, y: F.when(y.isNotNull(), F.hash(bare(x), bare(y))))
    chain = lambda w, h: F.when(h.isNotNull(), F.struct(w.bitwiseAND(F.lit(1).cast("long")).alias("spot"), F.hash(bare(w), h).alias("hash")))
    rows = rows.withColumn("__all", F.filter(F.zip_with("__content", after, chain), lambda c: c.isNotNull()))
    rows = rows.withColumn("__chains", F.array_distinct(F.filter("__all", lambda c: c.spot == 1).getField("hash")))
    spots = F.when(F.size("__chains") >= FEW, F.sort_array("__chains")).when(F.size("__all") > 0, F.sort_array(F.array_distinct(F.col("__all").getField("hash")))).otherwise(F.array(F.hash(F.lower(text))))
    return rows.withColumn(out, spots).drop("__words", "__content", "__all", "__chains")


def jaccard(a: Column, b: Column) -> Column:
    """Of two sets (arrays without repeats); 1 for two empty ones."""
    common = F.size(F.array_intersect(a, b))
    union = F.size(a) + F.size(b) - common
    return F.when(union == 0, 1.0).otherwise(common / union)


def as_string(sets: Column) -> Column:
    return F.array_join(sets.cast("array<string>"), " ")


def _id_cells(docs: DataFrame, cells: int) -> Column:
    """A cell for each doc_id, ascending with it: 64 quantiles at most, each cut into equal widths, so that the expression stays short. Places in a quantile are doubles, which cannot overflow."""
    coarse = min(64, cells)
    low, high, bounds = docs.agg(F.min("doc_id"), F.max("doc_id"), F.percentile_approx("doc_id", [i / coarse for i in range(1, coarse)], 10_000) if coarse > 1 else F.lit(None).cast("array<long>")).first()
    if low is None:
        return F.lit(0).cast("long")
    starts = sorted({low, *(bounds or [])})
    fine = -(-cells // coarse)
    doc_id = F.coalesce("doc_id", F.lit(low).cast("long"))
    k = F.size(F.filter(F.array(*map(F.lit, starts)), lambda e: e <= doc_id))
    edge = F.array(*(F.lit(float(e)) for e in [*starts, high]))
    begin, end = F.element_at(edge, k), F.element_at(edge, k + 1)
    within = (doc_id.cast("double") - begin) * fine / F.greatest(end - begin, F.lit(1.0))
    return ((k - 1) * fine + F.least(F.floor(within), F.lit(fine - 1))).cast("long")


def _buckets(cells: list[tuple[int, int, int]], each: float) -> list[tuple[int, int, int | None, int | None]]:
    """(cell, bucket, head, the bucket before) from (cell, bytes, least doc_id), ascending: consecutive cells of about ``each`` bytes share a bucket. The first cell of a bucket names its least doc_id, head, which the bucket before gets too; before the first is the last."""
    out, bucket, size = [], -1, 0
    for cell, n, least in cells:
        if bucket < 0 or size + n > each:
            bucket, size = bucket + 1, 0
            out.append((cell, bucket, least, bucket - 1))
        else:
            out.append((cell, bucket, None, None))
        size += n
    return [(c, b, h, bucket if p == -1 else p) for c, b, h, p in out]


def with_next(docs: DataFrame) -> DataFrame:
    """(doc_id, text) with spots, next_text and next_spots: those of the next row by doc_id (ties by text), of the last the first's. A row without doc_id has no place in the order and is its own next.

    Rows lie in buckets of doc_id; each bucket also gets a copy of the first row of the next one. Texts are shuffled once, each bucket to a task of its own.
    """
    spark, named = docs.sparkSession, docs.filter("doc_id is not null")
    total = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    each = max(BUCKET_BYTES, total / MAX_BUCKETS)
    celled = docs.withColumn("cell", _id_cells(named, CELLS * max(int(-(-total // each)), 1)))
    # About CELLS rows for each bucket.
    cells = celled.filter("doc_id is not null").groupBy("cell").agg(F.sum(F.octet_length("text")).alias("bytes"), F.min("doc_id").alias("head")).orderBy("cell").collect()
    table = _buckets([tuple(c) for c in cells], each)
    buckets = max((b for _, b, _, _ in table), default=0) + 1
    places = F.broadcast(spark.createDataFrame(table, "cell long, own int, head long, before int"))
    at = celled.join(places, "cell", "left")
    own = F.coalesce(F.when(F.col("doc_id").isNotNull(), F.col("own")), F.pmod(F.xxhash64("text"), F.lit(buckets)).cast("int"))
    place = lambda bucket, guest: F.struct(bucket.alias("bucket"), F.lit(guest).alias("guest"))
    both = F.when(F.col("doc_id") == F.col("head"), F.array(place(own, False), place(F.col("before"), True))).otherwise(F.array(place(own, False)))
    rows = at.select("doc_id", "text", F.explode(both).alias("at")).select("doc_id", "text", "at.bucket", "at.guest")
    rows = with_signatures(rows.repartitionById(buckets, "bucket"), "text", "spots")
    # A bucket's own rows, then its guests, then rows without doc_id.
    order = Window.partitionBy("bucket").orderBy(F.col("doc_id").isNull(), "guest", "doc_id", "text")
    following = lambda c: F.when(F.col("doc_id").isNull(), F.col(c)).otherwise(F.lead(c).over(order))
    return rows.withColumns({f"next_{c}": following(c) for c in ("text", "spots")}).filter("not guest").drop("bucket", "guest")


def compared(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, spots, edited_spots, near_edited, near_next for every row.

    The edited text has its last half replaced by the first characters, as many, of the next document. A null text counts as empty; a lone document is its own next. An empty table gives no rows; other columns are not looked at. A very long text is one row of a task, as everywhere in Spark.
    """
    rows = with_next(docs.select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text")))
    half = F.floor(F.col("n_chars") / 2).cast("int")
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.select("doc_id", "n_chars", "spots", "next_spots", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - half), F.substring("next_text", F.lit(1), half)).alias("edited"))
    rows = with_signatures(rows, "edited", "edited_spots")
    return rows.select("doc_id", "n_chars", F.sha2(F.col("edited").cast("binary"), 256).alias("edited_sha256"), "spots", "edited_spots", jaccard(F.col("spots"), F.col("edited_spots")).alias("near_edited"), jaccard(F.col("spots"), F.col("next_spots")).alias("near_next"))


def classes_of(sets: DataFrame) -> DataFrame:
    """spots, class_id, members of the classes of equal sets; class_id is the smallest doc_id, null where none has one."""
    return sets.groupBy("spots").agg(F.min("doc_id").alias("class_id"), F.count(F.lit(1)).alias("members"))


def similar_classes(sets: DataFrame, threshold: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """(pairs, classes) of ``sets`` (doc_id, spots). pairs: a, b, similarity of all classes of at least ``threshold``, a > b.

    Sets are partitioned by length, a partition spanning a factor of 1 / threshold: partners lie in one partition or the next. Within, sets meet by the rarest of their signatures, as many as a partner must share one of, if their lengths allow the threshold; only then are they compared.
    What shares a signature is compared in blocks, each pair of blocks by itself. Classes without doc_id are in no pair. All pairs come out: of n different near copies, up to n * (n - 1) / 2.
    """
    classes = materialise(classes_of(sets), "classes")
    sized = classes.filter("class_id is not null").select(F.col("class_id").alias("id"), "spots", F.size("spots").alias("n"))
    sized = sized.withColumn("band", F.floor(F.log("n") / F.log(F.lit(1 / threshold)) + 1e-9))
    spots = materialise(sized.select("id", "n", "band", F.explode("spots").alias("spot")), "spots")
    common = materialise(spots.groupBy("spot").agg(F.count(F.lit(1)).alias("documents")), "common")
    rank = F.row_number().over(Window.partitionBy("id").orderBy("documents", "spot"))
    prefix = join_one(spots, common, ["spot"], "documents").withColumn("rank", rank).filter(F.col("rank") <= F.col("n") - F.ceil(F.col("n") * threshold - 1e-9) + 1)
    # The sides of a spot: a row for each pair of blocks that its own block is in.
    prefix = prefix.withColumn("blocks", F.ceil(F.col("documents") / BLOCK)).withColumn("side", F.pmod(F.xxhash64("id"), "blocks")).withColumn("other", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    prefix = materialise(prefix.select("id", "n", "band", "spot", "side", F.least("side", "other").alias("x"), F.greatest("side", "other").alias("y")), "prefixes")
    left = prefix.select(F.col("id").alias("a"), F.col("n").alias("a_n"), F.col("side").alias("a_side"), "spot", "x", "y", F.explode(F.array("band", F.col("band") - 1, F.col("band") + 1)).alias("band"))
    right = prefix.select(F.col("id").alias("b"), F.col("n").alias("b_n"), F.col("side").alias("b_side"), "spot", "x", "y", "band")
    fits = (F.col("a") > F.col("b")) & (F.least("a_n", "b_n") >= F.greatest("a_n", "b_n") * threshold - 1e-9) & ((F.col("x") == F.col("y")) | (F.col("a_side") != F.col("b_side")))
    met = left.join(right, ["spot", "x", "y", "band"]).filter(fits).select("a", "b").distinct()
    both = met.join(sized.select(F.col("id").alias("a"), F.col("spots").alias("a_spots")), "a").join(sized.select(F.col("id").alias("b"), F.col("spots").alias("b_spots")), "b")
    return both.select("a", "b", jaccard(F.col("a_spots"), F.col("b_spots")).alias("similarity")).filter(F.col("similarity") >= threshold), classes


def similar_pairs(docs: DataFrame, threshold: float = 0.75) -> tuple[DataFrame, DataFrame]:
    """(pairs, members) of the documents' classes: members are doc_id, class_id. Rows without doc_id are left out."""
    known = docs.filter("doc_id is not null").select(F.col("doc_id").cast("long").alias("doc_id"), text_of("text").alias("text"))
    sets = materialise(with_signatures(known, "text", "spots").drop("text"), "sets")
    pairs, classes = similar_classes(sets, threshold)
    return pairs, join_one(sets, classes, ["spots"], "members").select("doc_id", "class_id")


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next, class_id for every row; class_id is the smallest doc_id with an equal fingerprint (null where none has a doc_id)."""
    rows = materialise(compared(docs), "fingerprints")
    found = join_one(rows, materialise(classes_of(rows), "classes"), ["spots"], "members")
    return found.select("doc_id", "n_chars", "edited_sha256", as_string(F.col("spots")).alias("fingerprint"), as_string(F.col("edited_spots")).alias("edited_fingerprint"), "near_edited", "near_next", "class_id")


def op8_spot_signatures(spark, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
