"""Mixing sources to target weights, in DataFrame expressions only.

* The words of a source, its documents laid end to end, are packed into blocks
  of ``block_words`` words (the last block of a source may be short).
* The mix is a sequence of slots, dealt to output shards of ``shard_slots``
  slots.  Every slot draws its source from the target weights, so the counts
  of a shard are a multinomial draw.  Draws of a source beyond its quota are
  handed to sources that stay below theirs, so totals meet the targets.
* The k-th slot of a source takes block ``p(k mod n)`` of its ``n`` blocks,
  where ``p`` is a keyed permutation of 0..n-1 that is computed, not stored;
  each round over the source uses a permutation of its own.
* Slots and blocks meet in an equi-join on (source, block).

The heavy tables (documents, blocks, slots) are partitioned by hashes of
document or block, so one source with a third of all rows makes no large task;
only tables with one row per source, or per (source, bucket), are ordered as a
whole.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from .common import BLANKS, WORD, materialise, text_key, word_array, word_count

WEIGHTS = (5.0, 2.0, 1.0)
ROUNDS = 16
ROWS_PER_BUCKET = 50_000
SLOTS_PER_BUCKET = 100_000
RUN_WORDS = 128


def source_targets(sizes: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0) -> DataFrame:
    """(source, weight, source_size, target) from (source, size).

    Sources in code-point order, null last, weigh ``weights`` in turn and
    share ``share`` times all words; none gets more than ``most`` times its
    own, and what it leaves is reshared by weight.  The solution is one level
    λ with target = min(most * size, λ * weight): sources in order of
    size/weight are full as long as the level of the rest does not reach them.
    One row per source is ordered here, never documents.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = W.orderBy(F.col("source").asc_nulls_last())
    everything = W.orderBy("ratio", "rank").rowsBetween(W.unboundedPreceding, W.unboundedFollowing)
    before = W.orderBy("ratio", "rank").rowsBetween(W.unboundedPreceding, -1)
    weight = F.element_at(F.array(*map(F.lit, weights)), F.pmod(F.col("rank"), F.lit(len(weights))).cast("int") + 1)
    d = per.withColumn("rank", F.row_number().over(order) - 1).withColumn("weight", weight) \
        .withColumn("cap", most * F.col("source_size")).withColumn("ratio", F.col("cap") / F.col("weight"))
    left = share * F.sum("source_size").over(everything) - F.coalesce(F.sum("cap").over(before), F.lit(0.0))
    weight_left = F.sum("weight").over(everything) - F.coalesce(F.sum("weight").over(before), F.lit(0.0))
    d = d.withColumn("level", F.greatest(left, F.lit(0.0)) / weight_left) \
        .withColumn("full", F.col("ratio") <= F.col("level"))
    # the first source that is not full fixes the level of all that follow
    level = F.min(F.when(~F.col("full"), F.struct("ratio", "rank", "level"))).over(everything)["level"]
    return d.withColumn("target", F.when(F.col("full"), F.col("cap")).otherwise(level * F.col("weight"))) \
        .select("source", F.col("rank").alias("sid"), "weight", "source_size", F.col("target").cast("double"))


def permuted(k: Column, n: Column, *key: Column) -> Column:
    """Keyed permutation of 0..n-1, by swap-or-not rounds over any domain size."""
    seeds = F.array(*[F.lit(r) for r in range(ROUNDS)])

    def swap(x: Column, r: Column) -> Column:
        mate = F.pmod(F.pmod(F.xxhash64(r, *key), n) - x, n)
        return F.when(F.pmod(F.xxhash64(F.greatest(x, mate), r, F.lit(1), *key), F.lit(2)) == 0, mate).otherwise(x)

    return F.aggregate(seeds, k.cast("long"), swap)


def pack(docs: DataFrame, block_words: int) -> DataFrame:
    """Segments of blocks: (source, doc, block, at, first_word, n).

    ``doc`` is struct(id, th); a segment is the ``n`` words of the document
    from ``first_word`` on, which lie at ``at`` in their block.  ``docs`` has
    (source, id, th, size); documents are laid out in order of a hash, and
    offsets are summed inside (source, bucket) and then over buckets.
    """
    n = docs.count()
    buckets = max(1, -(-n // ROWS_PER_BUCKET))
    doc = F.struct("id", "th")
    d = docs.filter(F.col("size") > 0).select("source", "size", doc.alias("doc")) \
        .withColumn("hash", F.xxhash64("doc")) \
        .withColumn("bucket", F.pmod(F.shiftrightunsigned("hash", 33), F.lit(buckets)))
    inside = W.partitionBy("source", "bucket").orderBy("hash", "doc").rowsBetween(W.unboundedPreceding, -1)
    d = d.withColumn("offset", F.coalesce(F.sum("size").over(inside), F.lit(0)))
    total = docs.filter(F.col("size") > 0).select("source", "size", F.xxhash64(doc).alias("hash")) \
        .groupBy("source", F.pmod(F.shiftrightunsigned("hash", 33), F.lit(buckets)).alias("bucket")) \
        .agg(F.sum("size").alias("words"))
    over = W.partitionBy("source").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    base = total.select("source", "bucket", F.coalesce(F.sum("words").over(over), F.lit(0)).alias("base"))
    b = base.withColumnsRenamed({"source": "b_source", "bucket": "b_bucket"})
    d = d.join(b, d.source.eqNullSafe(b.b_source) & (d.bucket == b.b_bucket)) \
        .withColumn("begin", F.col("base") + F.col("offset")).withColumn("end", F.col("begin") + F.col("size"))
    size = F.lit(block_words)
    d = d.withColumn("block", F.explode(F.sequence(
        F.floor(F.col("begin") / size), F.floor((F.col("end") - 1) / size))))
    start = F.greatest(F.col("begin"), F.col("block") * size)
    stop = F.least(F.col("end"), (F.col("block") + 1) * size)
    return d.select("source", "doc", "block", (start - F.col("block") * size).alias("at"),
                    (start - F.col("begin")).alias("first_word"), (stop - start).alias("n"))


def draw_slots(targets: DataFrame, block_words: int, shard_slots: int, seed: int) -> DataFrame:
    """The slots of the mix: (shard, slot, sid, source, block, take).

    ``take`` is the number of words the slot takes from the start of its block:
    the whole block, except where the last slots of a source are cut to make
    its words equal its target rounded down.
    """
    spark = targets.sparkSession
    b = F.lit(block_words)
    t = targets.withColumn("blocks", F.ceil(F.col("source_size") / b)).withColumn("goal", F.floor("target")) \
        .withColumn("short", F.col("source_size") - (F.col("blocks") - 1) * b) \
        .withColumn("quota", F.ceil(F.col("goal") / b)).filter(F.col("goal") > 0)
    # up to a block for each round over the source may be short: two spare slots, but never beyond two rounds
    t = t.withColumn("quota", F.greatest(F.col("quota"), F.least(F.col("quota") + 2, 2 * F.col("blocks"))))
    run = W.orderBy("sid").rowsBetween(W.unboundedPreceding, -1)
    t = t.withColumn("lo", F.coalesce(F.sum("quota").over(run), F.lit(0)))
    t = materialise(t.select("sid", "source", "blocks", "short", "goal", "quota", "lo",
                             (F.col("lo") + F.col("quota")).alias("hi")))
    slots, sources = t.agg(F.sum("quota"), F.count(F.lit(1))).first()
    slots = slots or 0
    # inverse distribution function by cells: a source is listed in each cell that its interval of quota meets
    cells = max(1, 4 * sources)
    cell = lambda x: F.floor(x * F.lit(cells) / F.lit(max(1, slots)))
    listed = t.withColumn("cell", F.explode(F.sequence(cell(F.col("lo")), cell(F.col("hi") - F.lit(1e-9))))) \
        .select("cell", "sid", "lo", "hi")
    drawn = spark.range(slots).select(F.col("id").alias("slot"), (
        F.pmod(F.xxhash64("id", F.lit(seed)), F.lit(1 << 52)) / F.lit(float(1 << 52)) * F.lit(slots)).alias("u")) \
        .withColumn("cell", cell(F.col("u")))
    drawn = drawn.join(listed, "cell").filter((F.col("u") >= F.col("lo")) & (F.col("u") < F.col("hi"))) \
        .select("slot", "sid")
    # number the draws of each source in slot order, bucket by bucket
    drawn = materialise(_numbered(drawn, "sid"))
    counts = drawn.groupBy("sid").agg(F.count(F.lit(1)).alias("got"))
    owed = t.join(counts, "sid", "left").withColumn("got", F.coalesce(F.col("got"), F.lit(0)))
    # draws beyond the quota go, in slot order, to the sources that miss some
    spare = _numbered(drawn.join(owed.select("sid", "quota"), "sid").filter(F.col("k") >= F.col("quota"))
                      .select("slot", F.lit(0).alias("all")), "all").select("slot", F.col("k").alias("j"))
    missing = owed.filter(F.col("got") < F.col("quota")) \
        .withColumn("from", F.coalesce(F.sum(F.col("quota") - F.col("got")).over(run), F.lit(0))) \
        .select("sid", "got", F.explode(F.sequence(F.lit(0), F.col("quota") - F.col("got") - 1)).alias("i"),
                F.col("from")) \
        .select("sid", (F.col("from") + F.col("i")).alias("j"), (F.col("got") + F.col("i")).alias("k"))
    moved = spare.join(missing, "j").select("slot", "sid", "k")
    kept = drawn.join(owed.select("sid", "quota"), "sid").filter(F.col("k") < F.col("quota")).select("slot", "sid", "k")
    d = kept.unionByName(moved).join(t, "sid")
    epoch = F.floor(F.col("k") / F.col("blocks"))
    d = d.withColumn("block", permuted(F.pmod(F.col("k"), F.col("blocks")), F.col("blocks"),
                                       F.col("sid"), epoch, F.lit(seed)))
    d = d.withColumn("length", F.when(F.col("block") == F.col("blocks") - 1, F.col("short")).otherwise(b))
    d = materialise(d.select((F.col("slot") / F.lit(shard_slots)).cast("long").alias("shard"), "slot", "sid", "source",
                             "k", "quota", "goal", "block", "length"))
    # words beyond the goal are cut from the last slots of the source (four at most, by the bound above)
    tail = F.col("k") >= F.col("quota") - 4
    sums = d.groupBy("sid").agg(F.greatest(F.sum("length") - F.first("goal"), F.lit(0)).alias("over"))
    back = W.partitionBy("sid").orderBy(F.col("k").desc()).rowsBetween(W.unboundedPreceding, -1)
    ends = d.filter(tail).join(sums, "sid") \
        .withColumn("cut", F.least(F.col("length"), F.greatest(
            F.lit(0), F.col("over") - F.coalesce(F.sum("length").over(back), F.lit(0))))) \
        .withColumn("take", F.col("length") - F.col("cut"))
    cols = ["shard", "slot", "sid", "source", "block", "take"]
    return d.filter(~tail).withColumn("take", F.col("length")).select(cols).unionByName(ends.select(cols)) \
        .filter(F.col("take") > 0)


def _numbered(slots: DataFrame, key: str) -> DataFrame:
    """``k``: rank of the slot among those of its key, without one task per key."""
    s = slots.withColumn("bucket", F.floor(F.col("slot") / F.lit(SLOTS_PER_BUCKET)))
    inner = W.partitionBy(key, "bucket").orderBy("slot")
    sums = s.groupBy(key, "bucket").agg(F.count(F.lit(1)).alias("n"))
    before = W.partitionBy(key).orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    base = sums.select(key, "bucket", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    return s.withColumn("i", F.row_number().over(inner) - 1).join(base, [key, "bucket"]) \
        .select("slot", key, (F.col("base") + F.col("i")).cast("long").alias("k"))


def sized(docs: DataFrame, id_col: str, text_col: str, source_col: str) -> DataFrame:
    """(source, id, th, size) of each distinct document row."""
    return docs.select(F.col(source_col).alias("source"), F.col(id_col).alias("id"),
                       text_key(F.col(text_col)).alias("th"), word_count(F.col(text_col)).alias("size"))


def mix(docs: DataFrame, weights=WEIGHTS, share: float = 1.5, most: float = 2.0, block_words: int = 256,
        shard_slots: int = 4096, seed: int = 11, id_col: str = "doc_id", text_col: str = "text",
        source_col: str = "source") -> tuple[DataFrame, DataFrame, DataFrame]:
    """(documents, targets, plan) of the mix.

    ``documents``: (source, id, th, size), ``th`` the text's fingerprint.
    ``targets``: see ``source_targets``.  ``plan``: one row per segment of a
    slot, (shard, slot, sid, source, block, at, doc, first_word, n): words
    ``first_word`` .. ``first_word + n`` of document ``doc``.

    Each source's words come to its target rounded down, and no block, hence
    no word, is taken more than twice where ``most`` is 2.  Reruns agree: every
    draw is a hash.  A null or empty text has size 0 and is never taken; a null
    source is a source of its own, ordered last; null ids are ids.  Rows
    repeated in full are laid out and taken one by one; their shares cannot be
    told apart.  An empty table, or one without words, gives an empty plan.
    """
    documents = materialise(sized(docs, id_col, text_col, source_col))
    targets = source_targets(documents, weights, share, most)
    slots = draw_slots(targets, block_words, shard_slots, seed)
    blocks = pack(documents, block_words).withColumnsRenamed({"source": "b_source", "block": "b_block"})
    met = slots.join(blocks, slots.source.eqNullSafe(blocks.b_source) & (slots.block == blocks.b_block))
    plan = met.filter(F.col("at") < F.col("take")) \
        .withColumn("n", F.least(F.col("n"), F.col("take") - F.col("at"))) \
        .select("shard", "slot", "sid", "source", "block", "at", "doc", "first_word", "n")
    return documents, targets, plan


def taken_words(documents: DataFrame, targets: DataFrame, plan: DataFrame) -> DataFrame:
    """``documents`` with source_size, target and the words the mix takes of each."""
    took = plan.groupBy("doc").agg(F.sum("n").alias("taken"))
    d = documents.withColumn("doc", F.struct("id", "th"))
    # rows repeated in full share their words evenly, so that none exceeds its bound
    twins = documents.groupBy(F.struct("id", "th").alias("doc")).agg(F.count(F.lit(1)).alias("rows")) \
        .filter(F.col("rows") > 1)
    t = targets.select(F.col("source").alias("t_source"), "source_size", "target")
    per = F.coalesce(F.col("rows"), F.lit(1))
    return d.join(took, "doc", "left").join(twins, "doc", "left") \
        .join(t, F.col("source").eqNullSafe(F.col("t_source")), "left") \
        .select("id", "th", "source", "size", "source_size", "target",
                F.floor(F.coalesce(F.col("taken"), F.lit(0)) / per).cast("long").alias("taken"))


def word_runs(text: Column) -> Column:
    """The text cut after every ``RUN_WORDS`` words; blanks before the first word are left out."""
    return F.regexp_extract_all(text, F.lit(rf"(?:{WORD}+(?:{BLANKS}+)?){{1,{RUN_WORDS}}}"), F.lit(0))


def mixed_text(docs: DataFrame, plan: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The mix itself: (shard, slot, source, id, at, first_word, n_words, text), one row per segment of a slot.

    A slot's segments in order of ``at`` give its words.  A document is cut
    once into runs of ``RUN_WORDS`` words, and a segment splits only the runs
    that it meets, so the work is linear in the text.  The plan holds the
    segments of all rows repeated in full, so one of these rows gives them all.
    Null and empty texts have no segments and give no rows; null ids match null
    ids; other columns of ``docs`` are not read, whatever their names.  An empty
    plan or table gives an empty result.
    """
    segments = plan.groupBy("doc").agg(F.collect_list(F.struct("shard", "slot", "source", "at", "first_word", "n")).alias("_s")) \
        .select(F.col("doc.id").alias("_id"), F.col("doc.th").alias("_th"), "_s")
    src = docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"), text_key(F.col(text_col)).alias("th"))
    # only rows repeated in full are shuffled to be made one
    twins = materialise(src.groupBy("id", "th").agg(F.count(F.lit(1)).alias("rows")).filter(F.col("rows") > 1)
                        .select(F.col("id").alias("t_id"), F.col("th").alias("t_th")))
    same = F.col("id").eqNullSafe(F.col("t_id")) & (F.col("th") == F.col("t_th"))
    src = src.join(twins, same, "left_anti").unionByName(
        src.join(twins, same, "left_semi").groupBy("id", "th").agg(F.first("text").alias("text")))
    met = src.join(segments.hint("shuffle_hash"), F.col("id").eqNullSafe(F.col("_id")) & (F.col("th") == F.col("_th")))
    # the runs of words are made in a generated row, so that no segment cuts the text again
    met = met.select("id", "_s", F.inline(F.array(F.struct(word_runs(F.col("text")).alias("_w")))))

    def words(s):
        first = F.floor(s["first_word"] / RUN_WORDS)
        runs = F.transform(F.sequence(first, F.floor((s["first_word"] + s["n"] - 1) / RUN_WORDS)),
                           lambda i: F.get("_w", i.cast("int")))
        return F.array_join(F.slice(word_array(F.array_join(runs, " ")),
                                    (s["first_word"] - first * RUN_WORDS + 1).cast("int"), s["n"].cast("int")), " ")

    cut = F.transform("_s", lambda s: F.struct(
        s["shard"].alias("shard"), s["slot"].alias("slot"), s["source"].alias("source"), s["at"].alias("at"),
        s["first_word"].alias("first_word"), s["n"].alias("n_words"), words(s).alias("text")))
    # an outer explode: for a plain one Spark would make the array a second time, in a filter on its size
    return met.select("id", cut.alias("_c")).select("id", F.explode_outer("_c").alias("c")) \
        .select("c.shard", "c.slot", "c.source", F.col("id").alias(id_col), "c.at", "c.first_word", "c.n_words", "c.text")
