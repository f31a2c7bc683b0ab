"""Exact dedup: of documents whose texts agree up to white space, the smallest id stays.

Method: an extendible-hash index on shared files. The directory doubles (one more leading hash bit)
until no bucket holds more keys than it has room for; a bucket that fits earlier keeps its shorter
prefix and several directory slots point to it. The directory gives every row its bucket, and
every run of consecutive buckets its owner. An owner task takes the rows of its key range, chains the keys
of one hash, compares whole texts byte by byte, and writes its answers to the index, which is the result.

* The directory is broadcast: a bucket's room grows with the number of keys beyond ``MAX_BUCKETS`` buckets, so
  that the directory stays bounded.
* A hash with more than 1/``HOT_SHARE`` of all rows (fewer than ``HOT_SHARE`` at any size) never goes to one
  owner whole: its texts meet in map-side partial aggregates, so that each task sends a text once, and the
  answers, without texts, are broadcast to the rows.

Only DataFrame functions run here. Rows are told apart by file and place, not by the caller's id.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from credere.llm.common import stage, with_row_key

BUCKET_KEYS = 1 << 10
MAX_BUCKETS = 1 << 17
HOT_SHARE = 4096
HOT_LEAST = 256     # copies that one owner can always take


def normal_text(text: Column) -> Column:
    """Each run of ``[\\x20\\x09-\\x0D]`` as one space, null as empty. A lone space is left alone."""
    return F.regexp_replace(F.coalesce(text, F.lit("")), r"[\x09-\x0D][\x20\x09-\x0D]*|\x20[\x20\x09-\x0D]+", " ")


def key_hash(norm: Column) -> Column:
    """The 64 bits that place a text in the index."""
    return F.xxhash64(norm)


def prefix(hash_col: str, bits: Column | int) -> Column:
    """The leading bits of a 64-bit hash (0 bits: 0). Split in two shifts: a shift by 64 would be one by 0."""
    bits = F.lit(bits) if isinstance(bits, int) else bits
    return F.shiftrightunsigned(F.call_function("shiftrightunsigned", F.col(hash_col), (63 - bits).cast("int")), 1)


def directory(keys: DataFrame) -> tuple[DataFrame, int]:
    """((slot, bucket, depth, owner), global depth) over the distinct hashes in column ``h``.

    ``bucket`` is the first slot that points to the bucket, ``depth`` its own number of bits. An
    owner takes consecutive buckets, about as many keys as one bucket has room for.
    """
    depth, total = 0, keys.count()
    room = max(BUCKET_KEYS, -(-total // MAX_BUCKETS))
    while total > room << depth:
        depth += 1
    while True:  # hashes are spread evenly, so this doubles once or twice
        cells = keys.groupBy(prefix("h", depth).alias("slot")).agg(F.count("*").alias("n"))
        if (cells.agg(F.max("n")).first()[0] or 0) <= room:
            break
        depth += 1
    cells = stage(cells, "hash_cells")
    # every ancestor of every cell with its keys; a bucket is the shortest prefix that fits
    up = cells.select("slot", "n", F.explode(F.sequence(F.lit(0), F.lit(depth))).alias("d"))
    node = F.call_function("shiftrightunsigned", F.col("slot"), (F.lit(depth) - F.col("d")).cast("int"))
    fits = up.withColumn("node", node).groupBy("d", "node").agg(F.sum("n").alias("n")).where(F.col("n") <= room)
    own = (up.withColumn("node", node).join(fits.select("d", "node"), ["d", "node"])
           .groupBy("slot").agg(F.min("d").alias("depth"), F.first("n").alias("n")))
    start = F.call_function("shiftleft", F.call_function("shiftrightunsigned", F.col("slot"), (F.lit(depth) - F.col("depth")).cast("int")),
                            (F.lit(depth) - F.col("depth")).cast("int"))
    slots = own.select("slot", start.alias("bucket"), "depth", "n")
    buckets = slots.groupBy("bucket").agg(F.sum("n").alias("keys"))  # a few times MAX_BUCKETS at most
    before = F.sum("keys").over(Window.orderBy("bucket").rowsBetween(Window.unboundedPreceding, -1))
    owners = buckets.select("bucket", F.floor(F.coalesce(before, F.lit(0)) / room).alias("owner"))
    return stage(slots.drop("n").join(owners, "bucket").select("slot", "bucket", "depth", "owner"), "hash_directory"), depth


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(id, keep_id, group_size, kept, text_sha256, bucket, chain): one row for each row of ``docs``.

    A null text is empty; empty texts are equal to each other. Rows repeated with their id keep one
    of them. A null id counts as larger than all others: it stays only where the group has no
    other, with a null ``keep_id``. ``chain`` is 0 unless different texts share a hash. Very long texts are
    compared whole; extra columns are ignored; an empty table gives an empty result.
    """
    rows = with_row_key(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")), "row")
    texts = rows.select("id", "row", normal_text(F.col("text")).alias("norm")).withColumn("h", key_hash(F.col("norm")))
    sha = F.sha2(F.col("norm").cast("binary"), 256).alias("sha")
    keys = stage(texts.groupBy("h").agg(F.count("*").alias("n")), "hash_keys")
    slots, depth = directory(keys)
    total = keys.agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
    hot = F.broadcast(keys.where((F.col("n") * HOT_SHARE > total) & (F.col("n") >= HOT_LEAST)).select("h"))
    placed = texts.withColumn("slot", prefix("h", depth)).join(F.broadcast(slots.select("slot", "bucket", "owner")), "slot")
    cols = ["id", "keep_id", "group_size", "kept", "sha", "bucket", "chain"]

    # owner tasks: one exchange, then everything happens within a key range
    ranked = Window.partitionBy("owner", "h", "norm").orderBy(F.col("id").isNull(), "id", "row")
    every = ranked.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    owned = (placed.join(hot, "h", "left_anti").drop("slot").repartition("owner")
             .select("*", F.first("id").over(every).alias("keep_id"), F.count("*").over(every).alias("group_size"), (F.row_number().over(ranked) == 1).alias("kept"))
             .withColumn("chain", F.dense_rank().over(Window.partitionBy("owner", "h").orderBy("norm")) - 1)
             .withColumn("sha", sha).select(cols))

    # hot hashes: the text is a grouping key, so bytes are compared in partial aggregates
    many = placed.join(hot, "h")
    met = many.groupBy("h", "norm").agg(F.min(F.struct(F.col("id").isNull().alias("none"), "id", "row")).alias("least"), F.count("*").alias("group_size"))
    answers = stage(met.select("h", sha, "least", "group_size", (F.row_number().over(Window.partitionBy("h").orderBy("norm")) - 1).alias("chain")), "hash_hot")
    told = (many.select("id", "row", "h", "bucket", sha).join(F.broadcast(answers), ["h", "sha"])
            .select("id", F.col("least.id").alias("keep_id"), "group_size", (F.col("row") == F.col("least.row")).alias("kept"), "sha", "bucket", "chain"))
    index = stage(owned.unionByName(told), "hash_index")
    return index.withColumnRenamed("sha", "text_sha256")


def drop_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, whole and unchanged."""
    keep = (exact_groups(docs, id_col, text_col).where("kept")
            .select(F.col("id").alias("__keep_id"), F.col("text_sha256").alias("__keep_sha")))
    own = docs.withColumn("__own_sha", F.sha2(normal_text(F.col(text_col)).cast("binary"), 256))
    return (own.join(keep, own[id_col].eqNullSafe(keep["__keep_id"]) & (own["__own_sha"] == keep["__keep_sha"]), "left_semi")
            .dropDuplicates([id_col, "__own_sha"]).drop("__own_sha"))


def exact_report(docs: DataFrame) -> DataFrame:
    """(doc_id, keep_id, group_size, kept, text_sha256) of every document."""
    return exact_groups(docs).select(F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", "text_sha256")
