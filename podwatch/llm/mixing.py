"""Mixing sources to target weights, by a splitting tree of exact block quotas. DataFrame functions only.

Sources weigh 1, 2, 3, 1, 2, 3, ... in order and share all words; a target stops at MOST_EPOCHS times the words
that the source has, and what is over is shared again. A source's documents are dealt to blocks by hash. An epoch draws
all its blocks in an order of its own; the last, partial epoch draws blocks until the target is reached and cuts the last of them there, so
that every source gives its target to the word.

The drawn blocks are the quotas of the sources. A tree over the output shards halves them: a node's left
half gets a multivariate hypergeometric sample of the node's quotas, source by source, and the right half the
rest. So every shard has its share of all blocks exactly, and the mix of a shard is that of a random
permutation, without one. The quotas of a shard then say which blocks of a source's order it draws; they are
disjoint. Inside a shard documents are shuffled by hash.

A node of the tree is one row with a number for each source. Everything else is joined by source and block, and
a source of any share of the documents is spread over its blocks.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podwatch.llm.scratch import Scratch, partitions

MOST_EPOCHS = 3
WEIGHTS = 3
SHARDS = 64
SEED = 17
# A source has a block for so many documents, and so many blocks at most; more documents then make larger blocks.
DOCS_PER_BLOCK, MOST_BLOCKS = 32, 4096
GROUP = 512  # sources drawn for one after another; beyond, groups of sources are drawn for first
LEVELS_A_TASK = 6  # of the tree before its nodes are dealt out again
BROADCAST_ROWS = 100_000  # of sources, and of blocks, a few megabytes
SALTS = 256  # parts of a source when there are too many sources to send to every task
SPACE = r"[\x20\x09-\x0D]"
DRAWS = "array<struct<epoch: int, shard: int, words: bigint>>"


def word_count(text: Column) -> Column:
    """Number of words between ASCII white space; 0 for NULL."""
    plain = F.trim(F.translate(text, "\t\n\x0b\x0c\r", "     "))
    # Of the pieces between single spaces, those that are empty stand inside longer white space.
    pieces = F.split(plain, " ")
    return F.when(F.coalesce(plain, F.lit("")) == "", F.lit(0)).otherwise(F.size(pieces) - F.size(F.filter(pieces, lambda p: p == ""))).cast("long")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is computed once."""
    return F.get(F.transform(F.array(value), use), F.lit(0))


def uniform(*of: Column) -> Column:
    """A number in [0, 1) from a hash of columns."""
    return F.shiftrightunsigned(F.xxhash64(*of), 11) / F.lit(float(1 << 53))


def hypergeometric(everything: Column, marked: Column, drawn: Column, u: Column) -> Column:
    """How many of ``drawn`` of ``everything`` are ``marked``: the inverse of the distribution at ``u``.

    Outcomes are taken from the mode upwards, then downwards; each chance follows from the one before. The
    walk ends where what is left is far below the spacing of ``u``, or where the outcomes do.
    """
    n_all, n_marked, n_drawn = (c.cast("double") for c in (everything, marked, drawn))
    low, high = F.greatest(F.lit(0), drawn + marked - everything), F.least(drawn, marked)
    mode = F.floor((n_drawn + 1) * (n_marked + 1) / (n_all + 2))
    mode = F.greatest(low, F.least(high, mode))
    share = n_marked / F.greatest(n_all, F.lit(1.0))
    spread = F.sqrt(F.greatest(n_drawn * share * (1 - share) * (n_all - n_drawn) / F.greatest(n_all - 1, F.lit(1.0)), F.lit(0.0)))
    reach = F.ceil(spread * 12) + 24

    def walk(mode: Column) -> Column:
        up = F.sequence(mode, F.least(high, mode + reach))
        down = F.when(mode > low, F.sequence(mode - 1, F.greatest(low, mode - reach), F.lit(-1).cast("long"))).otherwise(F.array().cast("array<bigint>"))
        gap = everything - marked - drawn

        def chance(k: Column, before: Column) -> Column:
            rising = before * ((marked - k + 1) * (drawn - k + 1)).cast("double") / (k * (gap + k)).cast("double")
            falling = F.when(k == mode - 1, F.lit(1.0)).otherwise(before)
            falling = falling * ((k + 1) * (gap + k + 1)).cast("double") / ((marked - k) * (drawn - k)).cast("double")
            return F.when(k == mode, F.lit(1.0)).when(k > mode, rising).otherwise(falling)

        steps = F.concat(up, down)
        start = F.struct(F.lit(0.0).alias("p"), F.lit(0.0).alias("sum"))
        total = F.aggregate(
            steps, start, lambda a, k: _bound(chance(k, a["p"]), lambda p: F.struct(p.alias("p"), (a["sum"] + p).alias("sum"))), lambda a: a["sum"]
        )

        def choose(goal: Column) -> Column:
            first = F.struct(F.lit(0.0).alias("p"), F.lit(0.0).alias("sum"), F.lit(None).cast("long").alias("found"))

            def step(a: Column, k: Column) -> Column:
                def after(p: Column) -> Column:
                    here = F.when(a["found"].isNull() & (a["sum"] + p > goal), k).otherwise(a["found"])
                    return F.struct(p.alias("p"), (a["sum"] + p).alias("sum"), here.alias("found"))

                return F.when(a["found"].isNotNull(), a).otherwise(_bound(chance(k, a["p"]), after))

            return F.aggregate(steps, first, step, lambda a: F.coalesce(a["found"], mode))

        return _bound(total * u, choose)

    return F.when(high <= low, low).otherwise(_bound(mode, walk))


def sampled(counts: Column, drawn: Column, *key: Column) -> Column:
    """A multivariate hypergeometric sample of ``drawn`` from ``counts`` of each kind: kind after kind, from what is left."""
    everything = F.aggregate(counts, F.lit(0).cast("long"), lambda a, c: a + c)
    start = F.struct(everything.alias("all"), drawn.alias("drawn"), F.array().cast("array<bigint>").alias("taken"))

    def step(a: Column, count: Column) -> Column:
        x = hypergeometric(a["all"], count, a["drawn"], uniform(*key, F.size(a["taken"])))
        return _bound(
            x,
            lambda x: F.struct((a["all"] - count).alias("all"), (a["drawn"] - x).alias("drawn"), F.array_append(a["taken"], x).alias("taken")),
        )

    return F.aggregate(counts, start, step, lambda a: a["taken"])


def _total(counts: Column) -> Column:
    return F.aggregate(counts, F.lit(0).cast("long"), lambda a, c: a + c)


def split_quotas(root: DataFrame, shards: int, seed: int = SEED) -> DataFrame:
    """(shard, counts) of every shard, from the one row ``counts`` of all: numbers of blocks by group of sources and source."""
    nodes = root.select(F.lit(0).cast("long").alias("node"), "counts")
    tasks = partitions(root.sparkSession)
    for level in range(shards.bit_length() - 1):
        key = (F.lit(seed), F.lit(level), F.col("node"))
        groups = F.transform("counts", _total)
        half = F.floor(_total(groups) / 2)
        of_groups = sampled(groups, half, *key, F.lit(-1))
        numbered = lambda parts: F.zip_with(parts, F.sequence(F.lit(0), F.size(parts) - 1), lambda n, g: F.struct(n.alias("n"), g.alias("g")))
        left = _bound(
            of_groups,
            lambda parts: F.zip_with("counts", numbered(parts), lambda counts, part: sampled(counts, part["n"], *key, part["g"])),
        )

        def halves(left: Column) -> Column:
            right = F.zip_with("counts", left, lambda a, b: F.zip_with(a, b, lambda x, y: x - y))
            node = F.col("node") * 2
            return F.array(F.struct(node.alias("node"), left.alias("counts")), F.struct((node + 1).alias("node"), right.alias("counts")))

        nodes = nodes.select(F.inline(_bound(left, halves)))
        if level % LEVELS_A_TASK == LEVELS_A_TASK - 1:
            nodes = nodes.repartition(tasks, "node")
    return nodes.select(F.col("node").cast("int").alias("shard"), "counts")


def _numbered(sources: DataFrame, scratch: Scratch) -> DataFrame:
    """Sources with ``sid``, their place in code-point order from 0, NULL last; no task sees all of them."""
    ordered = sources.orderBy(F.col("source").asc_nulls_last()).withColumn("m", F.monotonically_increasing_id())
    ordered = scratch.written(ordered.select("*", F.shiftright("m", 33).alias("part"), F.col("m").bitwiseAND((1 << 33) - 1).alias("at")), "ordered")
    # As many rows as the sort had partitions.
    sizes = ordered.groupBy("part").agg(F.count("*").alias("size"))
    first = sizes.select("part", (F.sum("size").over(Window.orderBy("part")) - F.col("size")).alias("first"))
    return ordered.join(F.broadcast(first), "part").select("source", "source_size", "n", (F.col("first") + F.col("at")).alias("sid"))


def with_targets(sources: DataFrame) -> DataFrame:
    """Sources (source_size, weight) with ``target``: shares by weight, none above MOST_EPOCHS times its size."""
    total, weight = sources.agg(F.sum("source_size"), F.sum("weight")).first()
    most = F.col("source_size") * MOST_EPOCHS
    share, above = (total / weight if weight else 0.0), None
    while True:
        over = most < F.col("weight") * F.lit(share)
        found = sources.agg(
            F.count_if(over).alias("above"),
            F.coalesce(F.sum(F.when(over, most)), F.lit(0)).alias("fixed"),
            F.coalesce(F.sum(F.when(~over, F.col("weight"))), F.lit(0)).alias("open"),
        ).first()
        if found["above"] == above or not found["open"]:
            break
        above, share = found["above"], (total - found["fixed"]) / found["open"]
    over = most < F.col("weight") * F.lit(share)
    return sources.withColumn("target", F.when(over, most.cast("double")).otherwise(F.col("weight") * F.lit(share)))


def _small(df: DataFrame) -> tuple[DataFrame, bool]:
    """The written frame, to be broadcast if its counted rows allow."""
    small = df.count() <= BROADCAST_ROWS
    return (F.broadcast(df) if small else df), small


def mix(docs: DataFrame, shards: int = SHARDS, seed: int = SEED, keep_text: bool = False) -> DataFrame:
    """(doc_id, source, size, source_size, target, draws) of every row of ``docs``, and its text if that is kept.

    ``draws`` are the document's places in the mix: epoch, shard, and how many of its words are taken, all but in
    the one block of a source at which its target is reached; there a document may give its first words only, or none.
    ``shards`` is a power of two. Reads doc_id, text and source; other columns are left alone. A NULL or empty text has no
    words, is drawn with its block and gives 0 words. NULL is a source of its own. Rows that repeat a doc_id, or
    have none, are documents of their own; rows equal in doc_id and text lie in one block. Without words all
    targets are 0 and nothing is drawn but empty texts. An empty table gives an empty result. The same rows
    give the same mix, however they are stored.
    """
    if shards < 1 or shards & (shards - 1):
        raise ValueError("the number of shards must be a power of two")
    scratch = Scratch(docs.sparkSession, "mixing")
    base = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), F.col("source").cast("string").alias("source"), F.col("text").alias("text")
    ).select("*", word_count(F.col("text")).alias("size"), F.xxhash64(F.lit(seed), "doc_id", "text").alias("h"))
    if not keep_text:
        base = scratch.written(base.drop("text"), "sized")

    sources = base.groupBy("source").agg(F.sum("size").alias("source_size"), F.count("*").alias("n"))
    sources = scratch.written(_numbered(sources, scratch).withColumn("weight", F.col("sid") % WEIGHTS + 1), "sources")
    whole = F.round("target").cast("long")
    some = F.greatest("source_size", F.lit(1))
    sources = with_targets(sources).select(
        "source", "source_size", "target", "sid",
        F.expr("least(%d, ceil(n / %d))" % (MOST_BLOCKS, DOCS_PER_BLOCK)).alias("blocks"),
        F.floor(whole / some).cast("int").alias("epochs"), (whole % some).alias("rest"),
    )
    sources = scratch.written(sources, "targets")

    named, small = _small(sources.withColumnRenamed("source", "of"))
    if small:
        placed = base.join(named, F.col("source").eqNullSafe(F.col("of")))
    else:
        salted = named.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
        placed = base.join(salted, F.col("source").eqNullSafe(F.col("of")) & (F.pmod(F.col("h"), F.lit(SALTS)) == F.col("salt"))).drop("salt")
    placed = placed.withColumn("block", F.pmod(F.xxhash64("h"), F.col("blocks")))

    draws = scratch.written(_draws(placed, sources, shards, seed, scratch), "draws")
    draws, _ = _small(draws.withColumnsRenamed({"sid": "s", "block": "b"}))
    columns = ["doc_id", "source", "size", "source_size", "target", *(["text"] if keep_text else [])]
    found = placed.join(draws, (F.col("sid") == F.col("s")) & (F.col("block") == F.col("b")), "left")
    found = found.withColumn("drawn", F.coalesce("drawn", F.array().cast("array<struct<epoch: int, shard: int, most: bigint>>")))
    is_cut = F.exists("drawn", lambda d: d["most"].isNotNull())

    def words(of: Callable[[Column], Column]) -> Column:
        return F.transform("drawn", lambda d: F.struct(d["epoch"].alias("epoch"), d["shard"].alias("shard"), of(d).alias("words"))).alias("draws")

    uncut = found.where(~is_cut).select(*columns, words(lambda d: F.col("size")))
    before = Window.partitionBy("sid", "block").orderBy("h").rowsBetween(Window.unboundedPreceding, -1)
    cut = found.where(is_cut).withColumn("before", F.coalesce(F.sum("size").over(before), F.lit(0)))
    cut = cut.select(
        *columns, words(lambda d: F.when(d["most"].isNull(), F.col("size")).otherwise(F.greatest(F.lit(0), F.least("size", d["most"] - F.col("before")))))
    )
    return uncut.unionByName(cut)


def _draws(placed: DataFrame, sources: DataFrame, shards: int, seed: int, scratch: Scratch) -> DataFrame:
    """(sid, block, drawn): the epochs and shards that draw each block, and how many of its words at most where it is cut."""
    blocks = placed.groupBy("sid", "block").agg(F.sum("size").alias("words"))
    epochs = sources.select("sid", "epochs", "rest", F.explode(F.sequence(F.lit(0), F.col("epochs"))).alias("epoch"))
    epochs = epochs.where((F.col("epoch") < F.col("epochs")) | (F.col("rest") > 0))
    own = F.xxhash64(F.lit(seed), "sid", "block", "epoch")
    ordered = blocks.join(epochs, "sid").withColumn("own", own)
    in_epoch = Window.partitionBy("sid", "epoch").orderBy("own", "block").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ordered = ordered.withColumn("after", F.sum("words").over(in_epoch))
    partial = F.col("epoch") == F.col("epochs")
    ordered = ordered.where(~partial | (F.col("after") - F.col("words") < F.col("rest")))
    ordered = ordered.withColumn("most", F.when(partial & (F.col("after") > F.col("rest")), F.col("rest") - F.col("after") + F.col("words")))
    place = F.row_number().over(Window.partitionBy("sid").orderBy("epoch", "own", "block")) - 1
    ordered = scratch.written(ordered.select("sid", "block", "epoch", "most", place.cast("long").alias("place")), "ordered-blocks")

    quotas = sources.select("sid").join(ordered.groupBy("sid").agg(F.count("*").alias("q")), "sid", "left")
    quotas = quotas.groupBy(F.floor(F.col("sid") / GROUP).alias("g")).agg(
        F.array_sort(F.collect_list(F.struct("sid", F.coalesce("q", F.lit(0)).alias("q")))).alias("of")
    )
    counts = F.transform(F.array_sort(F.collect_list(F.struct("g", F.transform("of", lambda x: x["q"]).alias("q")))), lambda x: x["q"])
    root = scratch.written(quotas.agg(counts.alias("counts")).where(F.size("counts") > 0), "quotas")
    leaves = split_quotas(root, shards, seed)
    leaves = leaves.select("shard", F.posexplode("counts").alias("g", "of")).select("shard", "g", F.posexplode("of").alias("i", "x")).where("x > 0")
    leaves = leaves.select("shard", (F.col("g").cast("long") * GROUP + F.col("i")).alias("sid"), "x")
    leaves = scratch.written(leaves, "leaves")
    until = F.sum("x").over(Window.partitionBy("sid").orderBy("shard"))
    spans = leaves.select("sid", "shard", until.alias("until"), "x")
    spans = spans.select("sid", "shard", F.explode(F.sequence(F.col("until") - F.col("x"), F.col("until") - 1)).alias("place"))
    drawn = ordered.join(spans, ["sid", "place"])
    return drawn.groupBy("sid", "block").agg(F.array_sort(F.collect_list(F.struct(F.col("epoch").cast("int").alias("epoch"), "shard", "most"))).alias("drawn"))


def mixed_shards(mixed: DataFrame, seed: int = SEED) -> DataFrame:
    """(shard, doc_id, epoch, words, text) of a mix with texts: partitions hold whole shards, each shuffled.

    A document of which only the first words are taken has them joined by single spaces.
    """
    rows = mixed.select("doc_id", "size", "text", F.explode("draws").alias("d")).where("d.words > 0")
    words = F.filter(F.split("text", f"{SPACE}+"), lambda w: w != "")
    first = F.array_join(F.slice(words, F.lit(1), F.col("d.words").cast("int")), " ")
    rows = rows.select(
        "d.shard", "doc_id", "d.epoch", "d.words", F.when(F.col("d.words") < F.col("size"), first).otherwise(F.col("text")).alias("text"),
        F.xxhash64(F.lit(seed), "d.shard", "d.epoch", "doc_id", "text").alias("turn"),
    )
    return rows.repartition("shard").sortWithinPartitions("shard", "turn").drop("turn")
