"""Mixing sources to target weights in blocks of words (operator 4), with DataFrame functions only.

The words of each source, document after document in a pseudorandom order, are packed into blocks of ``BLOCK`` words.
Each source has a target: its weight's part of all words, at most ``MOST`` times its own, the excess going to the
others by weight. The mix has a slot for every block that is taken, in output shards of ``SHARD`` slots.

How many slots of a shard each source gets is a multinomial draw by target, conditioned on the totals, which therefore
meet the targets exactly instead of by chance. The draws go down a binary tree over the shards: at a node, the slots of
each source that go left are drawn from how many there are and how many slots the left half has. Every draw comes from
a hash of its node, so each shard finds its own counts, and how many slots of a source lie in shards before it, without
any other shard, and shards are filled by as many tasks as there are groups of them. Inside a shard a permutation
places the slots. Within a source, slot ``j`` takes block ``permutation(j mod blocks)`` of pass ``j div blocks``, with another
permutation in each pass, so no block comes again before all came once. The last slot of a source is cut where its
target is reached. Slots and blocks are joined by (source, block).

Permutations are swap-or-not shuffles: rounds that swap an index with its mirror if a hash of the pair says so. They
are exact for any size, need no table, and run backwards with the rounds reversed.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from candlewright.llm._shared import cut

BLOCK, SHARD, MOST = 512, 1024, 3
WEIGHTS = (5, 2, 1)
ROUNDS = 24
#: Shards that share the upper levels of the tree of draws, as a power of two, and such groups that a task makes.
GROUP_LEVELS, TASK_GROUPS = 4, 64
#: Sources that a mix may have unless it is told of more; each shard draws for all of them, so more raise an error.
MAX_SOURCES = 4096
#: Slots up to which a draw goes slot by slot; beyond, the normal law stands for the hypergeometric one.
SMALL_DRAW = 32
#: Documents of a source that are put in order together at least.
BUCKET_ROWS = 100
BLANKS = " \t\n\x0b\f\r"


def word_count(text: Column) -> Column:
    """The number of runs of other than ASCII white space; 0 for null."""
    inner = F.btrim(text, F.lit(BLANKS))
    return F.when(F.length(inner) > 0, F.size(F.split(inner, "[\\x20\\x09-\\x0D]+"))).otherwise(0).cast("long")


def permuted(x: Column, n: Column, key: list[Column], backwards: bool = False) -> Column:
    """Where a keyed pseudorandom permutation of 0 .. n - 1 sends x, or what it sends to x."""
    rounds = range(ROUNDS)
    order = F.array(*[F.lit(r) for r in (reversed(rounds) if backwards else rounds)])

    def one(at: Column, r: Column) -> Column:
        mirror = F.pmod(F.pmod(F.xxhash64(*key, r, F.lit("mirror")), n) - at, n)
        swap = F.xxhash64(*key, r, F.greatest(at, mirror), F.lit("swap")).bitwiseAND(F.lit(1)) == 1
        return F.when(swap, mirror).otherwise(at)

    return F.aggregate(order, x.cast("long"), one)


def targets(sizes: DataFrame, weights: tuple[int, ...] = WEIGHTS, most: int = MOST) -> DataFrame:
    """(source, rank, weight, source_size, target) from rows (source, size).

    Weights repeat over the sources by code point, null last. Where the part of a source is above ``most`` times its
    size it stops there. With sources ordered by that limit over their weight, all from some place on share what is
    left in proportion, and the first place where this is below the limit is the one where resharing ends.
    """
    everything = Window.orderBy(F.lit(1)).rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    per = per.withColumn("rank", F.row_number().over(Window.orderBy(F.asc_nulls_last("source"))) - 1)
    per = per.withColumn("weight", F.element_at(F.array(*[F.lit(w) for w in weights]), (F.col("rank") % len(weights) + 1).cast("int")).cast("long"))
    per = per.withColumn("_cap", (F.col("source_size") * most).cast("long")).withColumn("_ratio", F.col("_cap").cast("double") / F.col("weight"))
    up = Window.orderBy("_ratio", "rank")
    before = F.coalesce(F.sum("_cap").over(up.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    after = F.sum("weight").over(up.rowsBetween(0, Window.unboundedFollowing))
    per = per.withColumn("_level", (F.sum("source_size").over(everything) - before).cast("double") / after)
    level = F.max(F.when(F.col("_level") <= F.col("_ratio"), F.col("_level"))).over(everything)
    per = per.withColumn("target", F.least(F.col("_cap").cast("double"), F.coalesce(level, F.lit(0.0)) * F.col("weight")))
    return per.select("source", F.col("rank").cast("long").alias("rank"), "weight", "source_size", "target")


def _uniform(*key: Column) -> Column:
    """A number in (0, 1) from a hash."""
    return (F.shiftrightunsigned(F.xxhash64(*key), 11).cast("double") + 0.5) / F.lit(float(1 << 53))


def _drawn(n: Column, t: Column, left: Column, key: list[Column]) -> Column:
    """How many of ``n`` among ``t`` slots are among the ``left`` first ones, if all orders are as likely."""
    least, most = F.greatest(F.lit(0).cast("long"), left - (t - n)), F.least(n, left)
    few = F.least(n, t - n)

    def one(taken: Column, i: Column) -> Column:
        return taken + (_uniform(*key, i) * (t - i) < left - taken).cast("long")

    exact = F.aggregate(F.sequence(F.lit(0).cast("long"), F.greatest(few, F.lit(1).cast("long")) - 1), F.lit(0).cast("long"), one)
    exact = F.when(few == 0, F.lit(0).cast("long")).otherwise(exact)
    share = left.cast("double") / F.greatest(t, F.lit(1))
    spread = F.sqrt(n * share * (1 - share) * (t - n) / F.greatest(t - 1, F.lit(1)))
    normal = F.sqrt(-2 * F.log(_uniform(*key, F.lit("a")))) * F.cos(_uniform(*key, F.lit("b")) * 6.283185307179586)
    guess = F.when(few > SMALL_DRAW, F.round(n * share + spread * normal).cast("long")).when(n <= t - n, exact).otherwise(left - exact)
    return F.when(t == 0, F.lit(0).cast("long")).otherwise(F.greatest(least, F.least(most, guess)))


def _halved(counts: Column, t: Column, left: Column, key: list[Column]) -> Column:
    """The counts of the left half of a node: one source after another, from the slots that are still to be dealt."""
    def one(acc: Column, i: Column) -> Column:
        n = F.element_at(counts, (i + 1).cast("int"))
        bound = F.transform(F.array(F.struct(n.alias("n"), _drawn(n, acc["t"], acc["left"], [*key, i]).alias("d"))), lambda x: F.struct((acc["t"] - x["n"]).alias("t"), (acc["left"] - x["d"]).alias("left"), F.array_append(acc["out"], x["d"]).alias("out")))
        return bound[0]

    start = F.struct(t.alias("t"), left.alias("left"), F.array().cast("array<bigint>").alias("out"))
    return F.aggregate(F.sequence(F.lit(0), F.size(counts) - 1), start, one)["out"]


def _descended(node: Column, index: Column, down: int, stop: int, shard: int, seed: int) -> Column:
    """The state of a node of the tree, from that of one above it.

    A state has, by source, ``n``: the slots below the node, and ``before``: those in shards to the left of it, and ``t``:
    all its slots. ``index`` is the number of the node among those of level ``stop``, levels counted from the shards.
    """

    def above(by: Column) -> Column:
        """The number of the node's ancestor so many levels up."""
        return F.floor(index.cast("double") / F.pow(F.lit(2.0), by))

    def step(acc: Column, level: Column) -> Column:
        left = F.least(acc["t"], F.pow(F.lit(2.0), level).cast("long") * shard)
        path, right = above(level + 1 - stop), F.pmod(above(level - stop), F.lit(2)) == 1
        drawn = _halved(acc["n"], acc["t"], left, [F.lit(seed), level, path])
        bound = F.transform(
            F.array(drawn),
            lambda d: F.when(right, F.struct(F.zip_with(acc["n"], d, lambda x, y: x - y).alias("n"), F.zip_with(acc["before"], d, lambda x, y: x + y).alias("before"), (acc["t"] - left).alias("t"))).otherwise(
                F.struct(d.alias("n"), acc["before"].alias("before"), left.alias("t"))
            ),
        )
        return bound[0]

    return node if down <= stop else F.aggregate(F.sequence(F.lit(down - 1), F.lit(stop), F.lit(-1)), node, step)


def check_sources(rows: DataFrame, most: int) -> None:
    """Raise where there are more sources than ``most``, before anything is worked out over all of them."""
    if rows.select("source").distinct().limit(most + 1).count() > most:
        raise ValueError(f"more than {most} sources: raise max_sources; the memory of a shard's draws grows with them")


def shard_counts(sources: DataFrame, shard: int = SHARD, seed: int = 11) -> DataFrame:
    """(shard, t, n, before): the slots of each output shard, and by source those in it and in the shards before it.

    ``sources`` has rank (0, 1, ...) and slots. Shards are full but for the last; sums over shards are the slots.
    """
    spark = sources.sparkSession
    total = sources.agg(F.coalesce(F.sum("slots"), F.lit(0))).first()[0]
    shards = -(-total // shard)
    levels = max(0, shards - 1).bit_length()
    group = min(GROUP_LEVELS, levels)
    groups = -(-shards // (1 << group))
    # One row with an array of the sources' slots, as a scalar subquery.
    by_rank = sources.agg(F.transform(F.array_sort(F.collect_list(F.struct("rank", "slots"))), lambda s: s["slots"]).alias("n")).scalar()
    tasks = max(1, min(groups, max(spark.sparkContext.defaultParallelism, groups // TASK_GROUPS)))
    root = spark.range(0, groups, 1, tasks).select(F.col("id").alias("_group"), by_rank.alias("_n"))
    root = root.withColumn("_node", F.struct(F.col("_n").alias("n"), F.transform("_n", lambda x: F.lit(0).cast("long")).alias("before"), F.lit(total).cast("long").alias("t")))
    upper = root.select("_group", _descended(F.col("_node"), F.col("_group"), levels, group, shard, seed).alias("_node"))
    each = upper.withColumn("shard", F.explode(F.sequence(F.col("_group") * (1 << group), F.least((F.col("_group") + 1) * (1 << group), F.lit(shards)) - 1)))
    return each.select("shard", _descended(F.col("_node"), F.col("shard"), group, 0, shard, seed).alias("_node")).select("shard", "_node.t", "_node.n", "_node.before")


def slots(sources: DataFrame, block: int = BLOCK, shard: int = SHARD, seed: int = 11) -> DataFrame:
    """(shard, position, rank, block, pass, words): the mix, slot by slot, from what ``targets`` returns.

    ``words`` is how many words of the block the slot takes, from its start: all, but for a source's last slot.
    ``sources`` is read several times and once at once, for the number of slots: best a written table.
    """
    size, n = F.col("source_size"), F.col("_blocks")
    # Sources of no size are in no pass; null keeps them out of divisions.
    s = sources.withColumn("source_size", F.nullif("source_size", F.lit(0))).withColumn("_words", F.when((size > 0) & (F.round("target") > 0), F.least(F.round("target").cast("long"), size * MOST)).otherwise(0))
    s = s.where("_words > 0").withColumn("_blocks", F.ceil(size / F.lit(block)).cast("long"))
    s = s.withColumn("_passes", F.expr("_words div source_size")).withColumn("_rest", F.col("_words") % size).withColumn("_tail", size - (n - 1) * block)
    # Where the short last block stands in the last pass decides how many slots that pass needs.
    s = s.withColumn("_short", permuted(n - 1, n, [F.lit(seed), F.col("rank"), F.col("_passes")], backwards=True))
    rest, short, tail = F.col("_rest"), F.col("_short"), F.col("_tail")
    s = s.withColumn(
        "_last",
        F.when(rest <= short * block, F.ceil(rest / F.lit(block))).when(rest <= short * block + tail, short + 1).otherwise(F.ceil((rest + block - tail) / F.lit(block))).cast("long"),
    )
    s = s.withColumn("slots", F.col("_passes") * n + F.col("_last"))
    some, _ = cut(s.where("slots > 0").withColumn("_i", F.row_number().over(Window.orderBy("rank")) - 1), "slot-sources")
    counts = shard_counts(some.select(F.col("_i").alias("rank"), "slots"), shard, seed)
    # A row for each source of a shard that has slots there, with its first slot and its first place in the shard.
    sums = F.aggregate("n", F.array(F.lit(0).cast("long")), lambda acc, x: F.array_append(acc, F.element_at(acc, -1) + x))
    per = counts.withColumn("offset", F.slice(sums, 1, F.size("n")))
    per = per.select("shard", "t", F.posexplode(F.arrays_zip("n", "before", "offset")).alias("_i", "_own"))
    per = per.select("shard", "t", "_i", F.col("_own.n").alias("_n"), F.col("_own.before").alias("_before"), F.col("_own.offset").alias("_offset")).where("_n > 0")
    per = per.join(F.broadcast(some.drop("source", "weight", "target")), "_i")  # as many rows as check_sources allows
    j = per.withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1))).withColumn("j", F.col("_before") + F.col("_k"))
    j = j.withColumn("pass", F.expr("j div _blocks")).withColumn("_at", F.expr("j % _blocks"))
    j = j.withColumn("block", permuted(F.col("_at"), n, [F.lit(seed), F.col("rank"), F.col("pass")]))
    length = F.when(F.col("block") == n - 1, tail).otherwise(F.lit(block))
    # Words of the last pass in the slots before j: full blocks, one of them short if it came already.
    done = F.col("_at") * block - F.when(F.col("_at") > short, F.lit(block) - tail).otherwise(F.lit(0))
    words = F.when(F.col("pass") == F.col("_passes"), F.least(length, rest - done)).otherwise(length)
    place = permuted(F.col("_offset") + F.col("_k"), F.col("t"), [F.lit(seed), F.lit(-1).cast("long"), F.col("shard")])
    return j.select("shard", place.alias("position"), "rank", "block", "pass", words.cast("long").alias("words"))


def placed(rows: DataFrame, many: int, order: list[Column]) -> DataFrame:
    """``rows`` (rank, size, _hash, _id, ...) with off: the words of the source before a row, in the source's order.

    The order is by a bucket of the hash and within it by ``order``. A bucket holds about the root of ``many`` rows, and
    its first offset comes from the sums of whole buckets, so nothing has to hold all rows of a source. Rows of one hash
    that are more than a bucket's are numbered by their ``_id`` in the written table and dealt to buckets of their own.
    """
    per = max(BUCKET_ROWS, math.isqrt(max(1, many)))
    large, _ = cut(rows.groupBy("_hash").agg(F.count("*").alias("_n")).where(F.col("_n") > per).select("_hash"), "large")
    rows = rows.join(large.withColumn("_large", F.lit(True)), "_hash", "left")
    usual = rows.where("_large IS NULL").withColumn("_nth", F.lit(0).cast("long"))
    hot = rows.where("_large").withColumn("_part", F.shiftright("_id", 16))
    base = hot.groupBy("_hash", "_part").agg(F.count("*").alias("_n"))
    base = base.withColumn("_from", F.coalesce(F.sum("_n").over(Window.partitionBy("_hash").orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_n")
    hot = hot.withColumn("_own", F.row_number().over(Window.partitionBy("_hash", "_part").orderBy("_id")) - 1).join(base, ["_hash", "_part"])
    hot = hot.withColumn("_nth", (F.col("_from") + F.col("_own")).cast("long")).drop("_part", "_own", "_from")
    rows = usual.unionByName(hot).drop("_large").withColumn("_bucket", F.pmod(F.xxhash64("_hash", F.floor(F.col("_nth") / per)), F.lit(max(1, -(-many // per)))))
    sums = rows.groupBy("rank", "_bucket").agg(F.sum("size").alias("_sum"))
    base = sums.withColumn("_base", F.coalesce(F.sum("_sum").over(Window.partitionBy("rank").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))).drop("_sum")
    own = Window.partitionBy("rank", "_bucket").orderBy(*order, "_nth").rowsBetween(Window.unboundedPreceding, 0)
    return rows.withColumn("_upto", F.sum("size").over(own)).join(base, ["rank", "_bucket"]).withColumn("off", F.col("_base") + F.col("_upto") - F.col("size")).drop("_bucket", "_base", "_upto", "_nth")


def pieces(rows: DataFrame, mix: DataFrame, keep: list[str], block: int = BLOCK) -> DataFrame:
    """Left join of the blocks of each row (rank, off, size, ``keep``) and the slots that take them, by index.

    first and last bound the words of the row that a slot takes, counted from the row's own start; they are null
    where no slot takes a block, and equal where a cut slot ends before the row begins.
    """
    cuts = rows.where("size > 0").select("rank", "off", "size", *keep, F.explode(F.expr(f"sequence(off div {block}, (off + size - 1) div {block})")).alias("block"))
    # Slots are exploded from a few source rows, so Spark would take them for small; they are as many as the blocks.
    joined = cuts.join(mix.hint("merge"), ["rank", "block"], "left")
    begin = F.greatest(F.col("off"), F.col("block") * block)
    end = F.least(F.col("off") + F.col("size"), F.col("block") * block + F.col("words"))
    taken = F.when(F.col("words").isNotNull(), F.greatest(F.lit(0).cast("long"), end - begin))
    return joined.withColumn("first", F.when(F.col("words").isNotNull(), begin - F.col("off"))).withColumn("last", F.col("first") + taken)


def mix_report(df: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", block: int = BLOCK, shard: int = SHARD, max_sources: int = MAX_SOURCES) -> DataFrame:
    """(key, size, source_size, target, taken, first_shard) for each row.

    Null and empty texts have size 0 and are never taken; a null source is one source, the last. Rows that repeat a
    key are rows of their own; rows equal in key, source and size are alike. No row is taken more than ``MOST`` times.
    first_shard is the first output shard with words of the row, or null.
    """
    rows, _ = cut(df.select(F.col(key).alias("key"), F.col(source).alias("source"), word_count(F.col(text)).alias("size"), F.monotonically_increasing_id().alias("_id")), "sizes")
    check_sources(rows, max_sources)
    sources, _ = cut(targets(rows), "targets")
    known = rows.join(sources.drop("weight"), rows["source"].eqNullSafe(sources["source"])).select("_id", "key", "size", "rank", "source_size", "target")
    mix = slots(sources, block, shard)
    some = known.where("size > 0").withColumn("_hash", F.xxhash64(F.col("key").cast("string"), "size"))
    laid = placed(some, rows.count(), [F.col("key"), F.col("size")])
    cuts = pieces(laid, mix, ["key", "source_size", "target"], block)
    taken = cuts.groupBy("rank", "off", "key", "size", "source_size", "target").agg(F.coalesce(F.sum(F.col("last") - F.col("first")), F.lit(0)).alias("taken"), F.min(F.when(F.col("last") > F.col("first"), F.col("shard"))).alias("first_shard"))
    none = known.where("size = 0").select("key", "size", "source_size", "target", F.lit(0).cast("long").alias("taken"), F.lit(None).cast("long").alias("first_shard"))
    out = taken.select("key", "size", "source_size", "target", "taken", "first_shard").unionByName(none)
    return out.select(F.col("key").alias(key), "size", "source_size", "target", "taken", "first_shard")


def mix_documents(df: DataFrame, text: str = "text", key: str = "doc_id", source: str = "source", block: int = BLOCK, shard: int = SHARD, max_sources: int = MAX_SOURCES) -> DataFrame:
    """The mix as rows with the columns of ``df``: one for each pass over a row that takes words of it.

    A whole pass has the text as it was; another has the words that its slots take, in order, with the white space
    before each. ``n_chars`` follows the text where there is such a column. Rows without words are in no block and go.
    """
    columns = df.columns
    rows = df.select(F.struct(*[F.col(c) for c in columns]).alias("_row"), F.col(source).alias("source"), F.col(key).alias("key"), word_count(F.col(text)).alias("size"), F.xxhash64(F.col(text)).alias("_print"))
    # Once written, a row's number is its name: everything but the last join goes without texts.
    rows, _ = cut(rows.withColumn("_id", F.monotonically_increasing_id()), "mix-rows")
    check_sources(rows, max_sources)
    sources, _ = cut(targets(rows), "targets")
    mix = slots(sources, block, shard)
    narrow = rows.where("size > 0").select("_id", "source", "key", "size", "_print")
    known = narrow.join(sources.select(F.col("source").alias("_source"), "rank"), F.col("source").eqNullSafe(F.col("_source"))).drop("_source", "source")
    laid = placed(known.withColumn("_hash", F.xxhash64(F.col("key").cast("string"), "size")), rows.count(), [F.col("key"), F.col("size"), F.col("_print")])
    cuts = pieces(laid, mix, ["_id"], block).where("last > first")
    parts = cuts.groupBy("_id", "pass").agg(F.sort_array(F.collect_list(F.struct("first", "last"))).alias("parts"), F.sum(F.col("last") - F.col("first")).alias("n"))
    joined = rows.select("_id", "_row", "size").join(parts, "_id")
    words = F.regexp_extract_all(F.col(f"_row.{text}"), F.lit("[\\x20\\x09-\\x0D]*[^\\x20\\x09-\\x0D]+"), F.lit(0))
    # An array of one binds the words, so that a text is cut once and not once for each part.
    chosen = F.transform(F.array(words), lambda w: F.flatten(F.transform("parts", lambda p: F.slice(w, (p["first"] + 1).cast("int"), (p["last"] - p["first"]).cast("int")))))
    some = F.array_join(chosen[0], "")
    joined = joined.withColumn("_text", F.when(F.col("n") == F.col("size"), F.col(f"_row.{text}")).otherwise(some))
    kinds = {f.name: f.dataType for f in df.schema.fields}
    new = {text: F.col("_text")} | ({"n_chars": F.length("_text").cast(kinds["n_chars"])} if "n_chars" in columns else {})
    return joined.select(*[new.get(c, F.col("_row")[c]).alias(c) for c in columns])
