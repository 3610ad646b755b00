"""Fuzzy line dedup with DataFrame operations alone.

Lines are normalised (lower case, runs of anything but letters and digits become one
blank).  The words of a line are dealt to blocks by their hash, and the SimHash of a block
is the majority over the hashes of its words.  A SimHash over all words would move about
nine of 64 bits when one word in ten changes, further than any pigeonhole join can reach;
dealt out, a changed word disturbs at most two blocks and leaves the others as they are.
So lines that differ in few words share whole blocks, and each block, or each choice of
blocks, is a join key:

* up to FEW words: every word is a block, the keys are all choices of all blocks but one
  (and all of them); in lines of one or two words half of the word left out is in the key;
* otherwise distinct words of LONG characters or more count (all words, if fewer than three
  are that long): up to FEW of them as above; below PAIRS of them BLOCKS blocks, and the keys are all
  choices of two; from there on BLOCKS * 2 ** j blocks, each of six to twelve words a key.

So any two lines that differ in one word, and from FEW counting words on nearly all that
differ in two, share a key; long lines with scattered edits share one the likelier the
fewer they are.  Lines whose length is just above a step also have the keys of the step
below it, so that an inserted word parts no pair.  Keys of fewer than LEAST words are left
out.  A block takes its words from all over a line, so a passage that many otherwise
unlike lines share seldom fills one.

Lines link if they share a key, their lengths allow it and their edit similarity is at
least SIMILARITY: in letters if both have up to LETTERS words, else in words, as the time
that the distance takes grows with the square of the length.  Of each connected group the first occurrence stays.  Copies of a line
are one node.  In each bucket all lines are first held against one of them, its hub, which
joins dense clusters with linear work; only buckets whose lines are then still in different
components are joined with themselves, so no link is lost and a cluster doesn't make all
its pairs.  Hot lines are added up before they are moved, hot keys meet in joins of
written tables, which Spark can split.
"""

from __future__ import annotations

from functools import reduce
from itertools import combinations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import store
from .components import components

SIMILARITY = 0.8
FEW = 9  # words up to which each word is a block of its own
LONG = 4  # characters of the words that count in longer lines
PAIRS = 36  # counting words below which keys are made of two blocks
BLOCKS = 6
LEAST = 3  # words that a key needs
LETTERS = 60  # words up to which edits are counted in letters, beyond in words
WIDE = 288  # counting words from which words are dealt to blocks as rows, below within their line's row
LANES = 5  # sums a block; each counts seven bits, in 8 bits of a long each
_MASK = 0x0001010101010101


def words_of(line: Column) -> Column:
    """The words of a line."""
    return F.array_remove(F.split(F.lower(line), r"[^\p{L}\p{N}]+", -1), "")


def normalised(text: Column) -> Column:
    """The text in lower case with one blank for each run of anything but letters, digits and line feeds."""
    return F.regexp_replace(F.lower(text), r"[^\p{L}\p{N}\n]+", " ")


def occurrences(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, line_no, lid, norm) of every line with a letter or digit; mark names the text, lid the line."""
    cut = docs.select("doc_id", F.xxhash64("text").alias("mark"), F.posexplode(F.split(normalised(F.col("text")), "\n", -1)).alias("line_no", "line"))
    cut = cut.select("doc_id", "mark", "line_no", F.trim("line").alias("norm")).where("norm <> ''")
    return cut.select("doc_id", "mark", "line_no", F.xxhash64("norm").alias("lid"), "norm")


def _hash(word: Column) -> Column:
    return F.xxhash64(word, F.lit(17))


def _rest(hashes: Column, i: Column) -> Column:
    """The key of all blocks but the i-th of sorted ones."""
    return F.xxhash64(F.concat(F.slice(hashes, F.lit(1), i - 1), F.slice(hashes, i + 1, F.size(hashes))), F.lit(19))


def _all_but_one(words: Column) -> Column:
    """Keys of a line whose words are blocks of their own: all of them, and all but one."""
    hashes = F.array_sort(F.transform(words, _hash))
    rest = F.transform(F.sequence(F.lit(1), F.size(words)), lambda i: _rest(hashes, i))
    return F.array_distinct(F.concat(F.array(F.xxhash64(hashes, F.lit(19))), F.when(F.size(words) > 2, rest).otherwise(F.array())))


def _halves(words: Column) -> Column:
    """Keys of a line of one or two words: one word is out, but for its first or last half."""

    def of(word: Column, i: Column) -> Column:
        other = F.filter(words, lambda w, k: k != i)
        size = F.length(word)
        halves = [F.floor((size - less) / 2).cast("int") for less in (0, 1)]
        ends = [(half, side) for half in halves for side in (1, 2)]
        cut = lambda half, side: F.substring(word, F.lit(1), half) if side == 1 else F.right(word, half)
        return F.array(*(F.when(half > 0, F.xxhash64(other, F.lit(side), cut(half, side))) for half, side in ends))

    return F.array_distinct(F.array_compact(F.flatten(F.transform(words, of))))


def _blocks(n: Column) -> Column:
    """Blocks of a line of n counting words whose keys are single blocks; 0 below PAIRS."""
    steps = F.floor(F.log2(F.greatest(n, F.lit(PAIRS)) / PAIRS))
    return F.when(n < PAIRS, F.lit(0)).otherwise(F.lit(BLOCKS) * F.pow(F.lit(2), steps)).cast("int")


def _lane(h: Column, k: int) -> Column:
    return F.shiftrightunsigned(h, k).bitwiseAND(F.lit(_MASK))


def _majority(c: Column, sums: list[Column]) -> Column:
    """Bits set in over half of the c words, of all counters of a sum at once: bit 7 of a counter tells."""
    most = (F.lit(127) - F.floor(c / 2)) * F.lit(_MASK)
    bits = [F.shiftleft(F.shiftrightunsigned(x + most, 7).bitwiseAND(F.lit(_MASK)), k) for k, x in enumerate(sums)]
    return reduce(lambda x, y: x.bitwiseOR(y), bits)


def _simhash(hashes: Column) -> Column:
    """The majority over the hashes of a block's words."""
    total = lambda k: F.aggregate(hashes, F.lit(0).cast("long"), lambda s, h: s + _lane(h, k))
    return _majority(F.size(hashes), [total(k) for k in range(LANES)])


def _counting() -> Column:
    """The words that count in longer lines, from words and the long ones of them."""
    return F.when(F.size("long") >= LEAST, F.col("long")).otherwise(F.col("words"))


def _hashed(lines: DataFrame) -> DataFrame:
    """(lid, words, counting, hashes) of lines (lid, norm); each step is a projection of its own, worked out once."""
    out = lines.select("lid", F.split("norm", " ").alias("words"))
    out = out.select("lid", "words", F.filter("words", lambda w: F.length(w) >= LONG).alias("long"))
    out = out.select("lid", "words", _counting().alias("counting"))
    return out.select("lid", "words", "counting", F.array_distinct(F.transform("counting", _hash)).alias("hashes"))


def _steps() -> Column:
    """Numbers of blocks of a line, from its hashes: its own, and the step below if it is just above one."""
    m = F.size("hashes")
    return F.array_distinct(F.array(_blocks(m), _blocks(F.floor(m / 1.125).cast("int"))))


def _block_key(blocks: Column, place: Column, c: Column, fp: Column) -> Column:
    return F.when(c >= LEAST, F.xxhash64(blocks, place, c, fp))


def line_keys(nodes: DataFrame) -> DataFrame:
    """(key, lid) of the distinct lines (lid, norm): all join keys of their fingerprints."""
    none = F.array().cast("array<long>")
    size, n, m = F.size("words"), F.size("counting"), F.size("hashes")
    row = _hashed(nodes).withColumn("steps", F.when((n >= FEW - 1) & (m < WIDE), _steps()).otherwise(F.array().cast("array<int>")))
    # six blocks, whose keys are pairs of them (0) or single ones (BLOCKS)
    six = F.array_contains("steps", 0) | F.array_contains("steps", BLOCKS)
    deal = lambda blocks, place: F.filter("hashes", lambda h: F.pmod(h, blocks) == place)
    row = row.select("lid", "words", "counting", "hashes", "steps", *(F.when(six, deal(F.lit(BLOCKS), F.lit(i))).otherwise(none).alias(f"b{i}") for i in range(BLOCKS)))
    row = row.select("lid", "words", "counting", "hashes", "steps", *(x for i in range(BLOCKS) for x in (F.size(f"b{i}").alias(f"c{i}"), _simhash(F.col(f"b{i}")).alias(f"fp{i}"))))
    c, fp = ([F.col(f"{x}{i}") for i in range(BLOCKS)] for x in ("c", "fp"))
    one = [_block_key(F.lit(BLOCKS), F.lit(i), c[i], fp[i]) for i in range(BLOCKS)]
    two = [F.when(c[i] + c[j] >= LEAST, F.xxhash64(F.lit(i), F.lit(j), c[i], c[j], fp[i], fp[j])) for i, j in combinations(range(BLOCKS), 2)]
    # more blocks, whose keys are single ones
    dealt = lambda blocks: F.transform(F.sequence(F.lit(0), blocks - 1), lambda p: deal(blocks, p))
    of = lambda blocks: F.transform(dealt(blocks), lambda b, p: _block_key(blocks, p, F.size(b), _simhash(b)))
    more = F.flatten(F.transform(F.filter("steps", lambda b: b > BLOCKS), of))
    keys = F.concat(
        F.when(size <= FEW, _all_but_one(F.col("words"))).otherwise(none),
        F.when(size <= 2, _halves(F.col("words"))).otherwise(none),
        F.when((size >= FEW) & (n <= FEW), _all_but_one(F.col("counting"))).otherwise(none),
        F.when(F.array_contains("steps", 0), F.array(*two)).otherwise(none),
        F.when(F.array_contains("steps", BLOCKS), F.array(*one)).otherwise(none),
        F.when(F.exists("steps", lambda b: b > BLOCKS), more).otherwise(none),
    )
    short = row.select(F.explode(F.array_compact(keys)).alias("key"), "lid")
    # very long lines: rows of one line stay in one task, so that its blocks are counted without another exchange
    wide = nodes.where(F.octet_length("norm") >= 2 * WIDE - 1).repartition("lid")
    wide = _hashed(wide).where(F.size("hashes") >= WIDE).select("lid", F.explode(_steps()).alias("blocks"), "hashes")
    word = wide.select("lid", "blocks", F.explode("hashes").alias("h"))
    sums = [F.sum(_lane(F.col("h"), k)).alias(f"s{k}") for k in range(LANES)]
    block = word.groupBy("lid", "blocks", F.pmod("h", "blocks").cast("int").alias("place")).agg(F.count("*").cast("int").alias("c"), *sums)
    key = _block_key(F.col("blocks"), F.col("place"), F.col("c"), _majority(F.col("c"), [F.col(f"s{k}") for k in range(LANES)]))
    return short.unionByName(block.select(key.alias("key"), "lid").where("key is not null"))


def alike(pairs: DataFrame) -> DataFrame:
    """Rows whose normalised lines x and y have an edit similarity of at least SIMILARITY.

    Edits are those of letters, or of words if a line has more than LETTERS.  Equal words at
    both ends are cut off first (with the blank after each), which leaves the distance as it
    is.  If as many words are left on both sides, those that differ from their opposite are a
    bound from above that takes linear time and mostly decides; only other pairs need
    levenshtein.  Each step is a projection of its own, so that none is worked out twice.
    """

    def equal_words(p: Column, q: Column) -> Column:
        differ = F.array_position(F.zip_with(p, q, lambda v, w: ~v.eqNullSafe(w)), True)
        return F.when(differ == 0, F.col("_least")).otherwise(F.least(differ - 1, F.col("_least"))).cast("int")

    def middle(words: str) -> Column:
        return F.slice(words, F.col("_head") + 1, F.size(words) - F.col("_head") - F.col("_tail"))

    def text(words: Column) -> Column:
        return F.when(F.size(words) > 0, F.concat(F.array_join(words, " "), F.lit(" "))).otherwise("")

    def letters(words: Column) -> Column:
        """A letter for each word, by 20 bits of its hash."""
        codes = F.transform(words, lambda w: F.lpad(F.hex(F.pmod(_hash(w), F.lit(0xF0000)) + 0x10000), 8, "0"))
        return F.decode(F.unhex(F.array_join(codes, "")), "UTF-32")

    share = 1 - SIMILARITY
    limit = F.when(F.col("_long"), F.greatest(F.size("_a"), F.size("_b"))).otherwise(F.greatest(F.length("x"), F.length("y")))
    out = pairs.withColumns({"_a": F.split("x", " "), "_b": F.split("y", " ")})
    out = out.withColumn("_long", F.greatest(F.size("_a"), F.size("_b")) > LETTERS)
    out = out.withColumn("_most", F.floor(limit * share + 1e-9).cast("int"))
    out = out.withColumn("_least", F.least(F.size("_a"), F.size("_b")))
    out = out.withColumn("_head", equal_words(F.col("_a"), F.col("_b")))
    out = out.withColumn("_tail", F.least(equal_words(F.reverse("_a"), F.reverse("_b")), F.col("_least") - F.col("_head")))
    # exploded from an array of one: the optimizer would move a plain filter below all steps
    out = out.select(*pairs.columns, F.explode(F.array(F.struct(middle("_a").alias("p"), middle("_b").alias("q"), "_most", "_long"))).alias("_m"))
    p, q, long, most = (F.col(f"_m.{k}") for k in ("p", "q", "_long", "_most"))
    cost = F.zip_with(p, q, lambda v, w: F.when(v.eqNullSafe(w), 0).when(long, 1).otherwise(F.greatest(F.length(v), F.length(w))))
    bound = F.when(F.size(p) == F.size(q), F.aggregate(cost, F.lit(0), lambda s, n: s + n)).otherwise(F.lit(1 << 30))
    exact = F.when(long, F.levenshtein(letters(p), letters(q))).otherwise(F.levenshtein(text(p), text(q)))
    return out.where(F.when(bound <= most, True).otherwise(exact <= most)).select(*pairs.columns)


def _verified(pairs: DataFrame, texts: DataFrame) -> DataFrame:
    """Of the pairs (a, b) of line names, a < b, those with like texts; texts: lid, norm."""
    near = store.cut(pairs.distinct(), "pairs")
    x, y = (texts.select(F.col("lid").alias(k), F.col("norm").alias(t)) for k, t in (("a", "x"), ("b", "y")))
    out = store.cut(alike(near.join(x, "a").join(y, "b")).select("a", "b"), "links")
    store.drop(pairs.sparkSession, near)
    return out


def _fits(n: str, m: str) -> Column:
    return F.least(n, m) >= F.greatest(n, m) * SIMILARITY


def links(nodes: DataFrame) -> DataFrame:
    """Edges (a, b) that connect every pair of linked lines; nodes: lid, norm, all distinct."""
    spark = nodes.sparkSession
    keys = line_keys(nodes).repartition("key")  # moved once: the join reads the same exchange
    shared = keys.groupBy("key").agg(F.min("lid").alias("hub"), F.max("lid").alias("top")).where("hub < top").select("key", "hub")
    busy = store.cut(keys.join(shared.hint("shuffle_hash"), "key"), "busy")  # few: most keys are one line's
    del keys, shared
    store.settle(spark)
    texts = store.cut(nodes.select("lid", "norm").join(busy.select("lid").distinct().hint("shuffle_hash"), "lid", "left_semi"), "linetexts", "zstd")
    store.settle(spark)
    sizes = texts.select("lid", F.length("norm").alias("n"))
    near_hub = busy.where("lid <> hub").select("hub", "lid").distinct()
    near_hub = near_hub.join(sizes, "lid").join(sizes.select(F.col("lid").alias("hub"), F.col("n").alias("m")), "hub").where(_fits("n", "m"))
    first = _verified(near_hub.select(F.col("hub").alias("a"), F.col("lid").alias("b")), texts)
    names = components(first)
    named = busy.select("key", "lid").join(names.withColumnRenamed("node", "lid"), "lid", "left").withColumn("component", F.coalesce("component", "lid"))
    named = store.cut(named, "named")
    store.drop(spark, busy)
    mixed = store.cut(named.groupBy("key").agg(F.min("component").alias("x"), F.max("component").alias("y")).where("x < y").select("key"), "mixed")
    left = store.cut(named.join(mixed, "key").join(sizes, "lid"), "unlike")
    side = {s: left.select("key", *(F.col(c).alias(f"{c}_{s}") for c in ("lid", "n", "component"))) for s in "ab"}
    pairs = side["a"].join(side["b"], "key").where("component_a < component_b").where(_fits("n_a", "n_b"))
    pairs = pairs.select(F.least("lid_a", "lid_b").alias("a"), F.greatest("lid_a", "lid_b").alias("b"))
    second = _verified(pairs, texts)
    for old in (named, mixed, left, texts):
        store.drop(spark, old)
    return first.unionByName(second)


def repeated_lines(docs: DataFrame) -> DataFrame:
    """(doc_id, mark, line_no) of every line that goes."""
    spark = docs.sparkSession
    seen = store.cut(occurrences(docs), "lines", "zstd")
    # added up in each task first: a line that holds a third of all rows moves once a task
    nodes = store.cut(seen.groupBy("lid").agg(F.first("norm").alias("norm")), "nodes", "zstd")
    store.settle(spark)
    names = components(links(nodes)).withColumnRenamed("node", "lid")
    store.drop(spark, nodes)
    place = F.struct("doc_id", "mark", "line_no")
    named = seen.drop("norm").join(names, "lid", "left").withColumn("component", F.coalesce("component", "lid"))
    named = store.cut(named.drop("lid"), "occurrences")
    store.drop(spark, seen)
    kept = named.groupBy("component").agg(F.min(place).alias("kept"), F.count("*").alias("n")).where("n > 1").drop("n")
    kept = store.cut(kept, "kept")
    gone = store.cut(named.join(kept, "component").where(~place.eqNullSafe(F.col("kept"))).select("doc_id", "mark", "line_no"), "gone")
    for old in (named, kept):
        store.drop(spark, old)
    return gone


def _fresh(name: str, taken: list[str]) -> str:
    """A column name that none of these has, whatever their case."""
    low = {c.lower() for c in taken}
    while name in low:
        name += "_"
    return name


def dedup_lines(docs: DataFrame) -> DataFrame:
    """The rows of docs with repeated lines cut out of text, and n_lines, n_removed.

    Lines end at line feeds; those without a letter or digit always stay.  Of each group
    of linked lines the occurrence of the smallest (doc_id, hash of the text, line number)
    stays.  A null text stays null and has no lines, an empty one has one; a null doc_id
    counts as the smallest.  Rows that share doc_id and text are one document: they lose
    the same lines, and none of them counts as the other's copy; rows that share a doc_id
    alone are different documents.  Distinct lines and texts are told apart by 64 bits of
    XXH64.  All other columns pass through, whatever their names; n_lines and n_removed
    replace columns of these names.  An empty table gives an empty one.
    """
    base = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("text").cast("string").alias("text"))
    names = {k: _fresh(k, docs.columns) for k in ("gone_id", "gone_mark", "gone_lines")}
    gone = repeated_lines(base).groupBy(F.col("doc_id").alias(names["gone_id"]), F.col("mark").alias(names["gone_mark"]))
    gone = gone.agg(F.collect_set("line_no").alias(names["gone_lines"]))
    columns = [c for c in docs.columns if c.lower() not in ("n_lines", "n_removed")]
    docs = docs.drop("n_lines", "n_removed")
    same = F.col("doc_id").cast("long").eqNullSafe(F.col(names["gone_id"])) & (F.xxhash64(F.col("text").cast("string")) == F.col(names["gone_mark"]))
    joined = docs.join(gone.hint("shuffle_hash"), same, "left")
    lines = F.col(names["gone_lines"])
    kept = F.filter(F.split("text", "\n", -1), lambda _, i: ~F.array_contains(lines, i))
    text = F.when(lines.isNull(), F.col("text")).otherwise(F.array_join(kept, "\n"))
    count = F.length("text") - F.length(F.replace("text", F.lit("\n"), F.lit(""))) + 1
    return joined.select(
        *(text.alias(c) if c == "text" else F.col(f"`{c}`") for c in columns),
        F.coalesce(count, F.lit(0)).cast("long").alias("n_lines"),
        F.coalesce(F.size(lines), F.lit(0)).cast("long").alias("n_removed"),
    )


def keep_lines(docs: DataFrame) -> DataFrame:
    """docs with repeated lines cut out; rows whose last word went that way go as well.

    n_chars, where docs has it, follows the new text.
    """
    done = dedup_lines(docs).where(~((F.col("n_removed") > 0) & ~F.col("text").rlike(r"[\p{L}\p{N}]")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        done = done.withColumn("n_chars", F.when(F.col("n_removed") > 0, F.length("text")).otherwise(F.col("n_chars")).cast(kind))
    return done.select(*(F.col(f"`{c}`") for c in docs.columns))
