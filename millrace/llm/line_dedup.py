"""Fuzzy line deduplication by MinHash, banding, exact Jaccard and components.

A line's shingles are its runs of five characters, at every position (a shorter line
is one shingle). Equal lines are one node, known by a 64-bit hash. :data:`BANDS` *
:data:`ROWS` minima of the shingle hashes, under masks, are taken in one aggregation;
lines that agree in all minima of a band are candidates: all pairs of a bucket of up to
``pairs_up_to`` lines. Larger buckets first link each line to the smallest
and the largest one (by hash). Where that leaves several components, :data:`DRAWN` lines meet
those of other components, and at last every line outside the largest component
meets all lines of other components. Buckets are dealt over parts of about :data:`PART_LINES`
lines, so that none lands in one task. Lines that share a bucket by chance are told apart as they meet, by
how many of all their minima are equal (:func:`_least_equal`; a pair of the asked similarity is taken for such
with a probability below 1e-7). Where lines of other components are left beside a line, a map of the parities
of its shingles rules out pairs that can't be similar, never others: the maps of two lines differ by what only
one of them has, however much they share. The rest is verified by exact Jaccard similarity of the whole
shingle sets, at least ``similarity``, and connected components of the verified pairs
are found by star contractions, the same as those of all pairs of the buckets. A pair
of similarity 0.8 is found with a probability of 0.985, of 0.9 with 0.9999.

Of each component one line stays: the first one (by line number) of the smallest
doc_id; of rows that repeat this doc_id, that of the smallest text hash. Lines
without a word are neither counted nor removed. Null and empty texts have no lines;
a null doc_id counts as larger than any other. Rows alike in doc_id and text count
as one. Empty tables give empty results; further columns are ignored, or kept by
:func:`keep_lines`.
"""

from __future__ import annotations

import math
import random
from collections.abc import Callable
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from millrace.llm.common import Scratch, cut, fresh
from millrace.llm.graph import components

BANDS, ROWS = 8, 4
PART_LINES = 512
DRAWN = 6
SIMILARITY, PAIRS_UP_TO = 0.8, 4
BROADCAST_LINES = 1 << 20
#: Texts of more lines than can be broadcast are looked up in so many turns at most, each of which shuffles those of its own hashes only.
TURNS = 4
K, STEP, WORDS = 5, 16, 16
#: A line in pieces that hold STEP shingles each, so that most of the work is done by columns and not by rows.
PIECE = rf"(?s)(?=(.{{{K},{K + STEP - 1}}}|^.{{1,{K - 1}}}(?!.))).{{1,{STEP}}}"
#: Every shingle of a line.
SHINGLE = rf"(?s)(?=(.{{{K}}}|^.{{1,{K - 1}}}(?!.)))."
LAST = (1 << 63) - 1


def _lines(docs: DataFrame) -> DataFrame:
    """(doc, text_hash, number, line, lid) of every line that has a word."""
    rows = docs.select(F.coalesce("doc_id", F.lit(LAST)).alias("doc"), F.xxhash64("text").alias("text_hash"), F.posexplode(F.split("text", "\n")).alias("number", "line"))
    return rows.where(F.trim("line", F.lit(" \t\r\x0b\x0c")) != "").withColumn("lid", F.xxhash64("line"))


def _shingles(line: str | Column = "line") -> Column:
    """The shingles of a line, with repeats, as hashes. Those of a line of single bytes are cut out by places."""
    text = F.col(line) if isinstance(line, str) else line
    places = F.sequence(F.lit(1), F.greatest(F.length(text) - (K - 1), F.lit(1)))
    cut_out = F.transform(F.array(text.cast("binary")), lambda raw: F.transform(places, lambda i: F.xxhash64(F.substring(raw, i, F.lit(K)))))[0]
    return F.when(F.octet_length(text) == F.length(text), cut_out).otherwise(F.transform(F.regexp_extract_all(text, F.lit(SHINGLE), F.lit(1)), lambda x: F.xxhash64(x)))


def _signed(x: int) -> int:
    return x - (1 << 64) if x >= 1 << 63 else x


def _minima() -> list[Column]:
    """Minima of the shingle hashes in BANDS * ROWS orders: the hash and its halves swapped, each under
    masks whose leading bits all differ, so that every order starts at another part of the hashes."""
    rng = random.Random(11)
    orders = BANDS * ROWS
    masks = [((k // 2) * (1 << 64) // (orders // 2)) ^ rng.getrandbits(60) for k in range(orders)]
    return [F.min(F.least(*(F.col(f"h{k % 2}_{i}").bitwiseXOR(F.lit(_signed(m))) for i in range(STEP)))).alias(f"m{k}") for k, m in enumerate(masks)]


def _hashes(piece: Column, raw: Column, size: Column) -> list[Column]:
    """Hashes of the shingles of a piece, the first one in place of missing ones. Bytes stand for the
    characters of a piece that has as many of them: they are cut out faster."""

    def shingle(i: int) -> Column:
        return F.when(F.octet_length(raw) == size, F.xxhash64(F.substring(raw, i + 1, K))).otherwise(F.xxhash64(F.substring(piece, i + 1, K)))

    return [shingle(0), *(F.when(size >= i + K, shingle(i)).otherwise(shingle(0)) for i in range(1, STEP))]


def _hashed(lines: DataFrame) -> DataFrame:
    """``lines`` with (i, size, h0_*) of every piece of their column line: number, characters, hashes of its shingles.
    Lines of single bytes are cut by places, others by PIECE."""
    rest = [c for c in lines.columns if c != "line"]
    single = F.octet_length("line") == F.length("line")
    pieces = F.when(~single, F.regexp_extract_all("line", F.lit(PIECE), F.lit(1)))
    rows = lines.select(*rest, F.col("line").cast("binary").alias("whole"), pieces.alias("pieces"))
    last = F.when(F.col("pieces").isNull(), F.shiftright(F.greatest(F.octet_length("whole") - K, F.lit(0)), STEP.bit_length() - 1)).otherwise(F.size("pieces") - 1)
    rows = rows.select("*", F.explode(F.sequence(F.lit(0), last)).alias("i"))
    raw = F.when(F.col("pieces").isNull(), F.substring("whole", F.shiftleft("i", STEP.bit_length() - 1) + 1, F.lit(K + STEP - 1))).otherwise(F.element_at("pieces", F.col("i") + 1).cast("binary"))
    rows = rows.select(*rest, "i", raw.alias("raw"))
    rows = rows.select(*rest, "i", "raw", F.col("raw").cast("string").alias("piece")).withColumn("size", F.length("piece"))
    return rows.select(*rest, "i", "size", *(h.alias(f"h0_{k}") for k, h in enumerate(_hashes(F.col("piece"), F.col("raw"), F.col("size")))))


def _maps(docs: DataFrame, lids: DataFrame, turn: tuple[int, int] = (0, 1)) -> DataFrame:
    """(lid, map) of these distinct lines; ``map``: the number ``t`` of different shingles and, in WORDS words of bits, at
    each place whether an odd number of them falls on it. The maps of two lines differ where an odd number of those
    that only one of them has do: the shingles that both have, many as they are, hide none of these."""
    odd = "bit_xor(if((shiftrightunsigned(h, 6) & {1}) = {0}, shiftleft(1L, cast(h & 63 AS int)), 0L)) AS w{0}".format
    sets = _texts(docs, lids, turn).select("lid", F.array_distinct(_shingles()).alias("set"))
    placed = sets.select("lid", F.size("set").alias("t"), F.explode("set").alias("h"))
    maps = placed.groupBy("lid").agg(F.min("t").alias("t"), *(F.expr(odd(w, WORDS - 1)) for w in range(WORDS)))
    return maps.select("lid", F.struct("t", *(f"w{w}" for w in range(WORDS))).alias("map"))


def _may_match(x: str, y: str, similarity: float) -> Column:
    """False only where the shingle sets can't be so similar. Each place where the maps differ stands for a shingle that only
    one line has, and of d such shingles among n in both sets the similarity is (n - d) / (n + d)."""
    apart = sum((F.bit_count(F.expr(f"{x}.w{w} ^ {y}.w{w}")) for w in range(WORDS)), F.lit(0))
    return apart <= (F.col(f"{x}.t") + F.col(f"{y}.t")) * F.lit((1 - similarity) / (1 + similarity) + 1e-9)


def _least_equal(similarity: float) -> int:
    """So many equal minima have two lines of this similarity, but for a probability below 1e-7 if minima are independent."""
    n, less, k = BANDS * ROWS, 0.0, 0
    while k < n and (less := less + math.comb(n, k) * similarity**k * (1 - similarity) ** (n - k)) < 1e-7:
        k += 1
    return k


def _may_agree(x: str, y: str, similarity: float) -> Column:
    """False where fewer minima are equal than lines of this similarity have. A sketch holds six bits of each
    minimum, in fields of seven: to add as many ones fills the seventh bit where minima differ."""
    ones, seventh = (sum(b << 7 * i for i in range(8)) for b in (0x3F, 0x40))
    fields = (F.col(f"{x}.s{k}").bitwiseXOR(F.col(f"{y}.s{k}")) + F.lit(ones) for k in range(BANDS * ROWS // 8))
    apart = sum((F.bit_count(f.bitwiseAND(F.lit(seventh))) for f in fields), F.lit(0))
    return apart <= BANDS * ROWS - _least_equal(similarity)


def _signatures(docs: DataFrame) -> DataFrame:
    """(lid, doc, n, bands, sketch) of every distinct line: its smallest doc, its occurrences, its band keys and six bits of each minimum.
    Lines are settled before they are cut into pieces."""
    lines = _lines(docs).groupBy("lid").agg(F.min("doc").alias("doc"), F.count(F.lit(1)).alias("n"), F.first("line").alias("line"))
    swapped = (F.shiftleft(f"h0_{i}", 32).bitwiseOR(F.shiftrightunsigned(f"h0_{i}", 32)).alias(f"h1_{i}") for i in range(STEP))
    signed = _hashed(lines).select("*", *swapped).groupBy("lid").agg(F.min("doc").alias("doc"), F.min("n").alias("n"), *_minima())
    bands = F.array(*(F.xxhash64(F.lit(b), *(f"m{b * ROWS + r}" for r in range(ROWS))) for b in range(BANDS)))
    sketch = (reduce(Column.bitwiseOR, (F.shiftleft(F.col(f"m{8 * k + i}").bitwiseAND(0x3F), 7 * i) for i in range(8))).alias(f"s{k}") for k in range(BANDS * ROWS // 8))
    return signed.select("lid", "doc", "n", bands.alias("bands"), F.struct(*sketch).alias("sketch"))


def _buckets(scratch: Scratch, signed: DataFrame) -> DataFrame:
    """(band, lid, size, map, salts) of every band that several lines share; a large one is split into ``salts`` parts. ``map``: the line's sketch."""
    banded = signed.select("lid", F.explode("bands").alias("band")).repartition("band")
    sizes = banded.groupBy("band").agg(F.count("lid").alias("size")).where("size > 1")  # of the column that is joined, so that both read one shuffle
    with Scratch() as own:
        shared = own.cut(banded.join(sizes.hint("shuffle_hash"), "band"))
        return scratch.cut(shared.join(signed.select("lid", F.col("sketch").alias("map")), "lid").select("band", "lid", "size", "map", F.ceil(F.col("size") / PART_LINES).cast("int").alias("salts")))


def _met(some: DataFrame, every: DataFrame, only: Column | None = None) -> DataFrame:
    """Rows of ``some`` (band, salts, ...) beside those of ``every`` (band, salts, y, ...) in their bands; with ``only``, those
    of ``some`` alone that meet one for which it holds. Rows of ``every`` are dealt over a band's parts; ``some`` is repeated in each of them."""
    dealt = every.withColumn("salt", F.pmod(F.xxhash64("y"), F.col("salts"))).drop("salts")
    spread = some.withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("salts") - 1))).drop("salts")
    if only is None:
        return spread.join(dealt, ["band", "salt"])
    x, y = spread.alias("some"), dealt.alias("every")
    return x.join(y, (F.col("some.band") == F.col("every.band")) & (F.col("some.salt") == F.col("every.salt")) & only, "left_semi")


def _as(rows: DataFrame, name: str) -> DataFrame:
    return rows.select("band", "salts", F.col("lid").alias(name), F.col("map").alias(f"map_{name}"))


def _pair(met: DataFrame, similarity: float, may: Callable[..., Column] = _may_match) -> DataFrame:
    """Pairs (a, b), a > b, of lines that met and may match."""
    return met.where(may("map_x", "map_y", similarity)).select(F.greatest("x", "y").alias("a"), F.least("x", "y").alias("b"))


def _candidates(shared: DataFrame, similarity: float, pairs_up_to: int) -> DataFrame:
    """Distinct pairs (a, b), a > b: all of a bucket of up to ``pairs_up_to`` lines; in larger ones, those with its smallest or largest lid."""
    few, many = shared.where(F.col("size") <= pairs_up_to), shared.where(F.col("size") > pairs_up_to)
    paired = _as(few, "x").drop("salts").join(_as(few, "y").drop("salts"), "band").where("x > y")
    line = F.struct("lid", "map")
    pivots = many.groupBy("band", "salts").agg(F.min_by(line, "lid").alias("least"), F.max_by(line, "lid").alias("most"))
    chosen = pivots.select("band", "salts", F.explode(F.array("least", "most")).alias("p")).select("band", "salts", F.col("p.lid").alias("x"), F.col("p.map").alias("map_x"))
    through = _met(chosen, _as(many, "y")).where("x <> y")
    return _pair(paired, similarity, _may_agree).unionAll(_pair(through, similarity, _may_agree)).distinct()


def _open(scratch: Scratch, rows: DataFrame, roots: DataFrame) -> DataFrame:
    """Those of ``rows`` (band, salts, lid, map), with (root, rest), whose bucket ``roots`` doesn't connect yet; ``rest``: outside its largest component."""
    rooted = scratch.cut(rows.join(roots, rows.lid == roots.node, "left").select("band", "salts", "lid", "map", F.coalesce(roots.root, rows.lid).alias("root")))
    parts = rooted.groupBy("band", "root").agg(F.count(F.lit(1)).alias("size"))
    largest = parts.groupBy("band").agg(F.max_by("root", F.struct("size", "root")).alias("largest"), F.count(F.lit(1)).alias("parts")).where("parts > 1")
    return scratch.cut(rooted.join(largest, "band").withColumn("rest", F.col("root") != F.col("largest")).drop("parts", "largest"))


def _named(open_: DataFrame, name: str) -> DataFrame:
    return open_.select("band", "salts", *(F.col(c).alias(f"{c}_{name}") for c in ("map", "root", "rest")), F.col("lid").alias(name))


def _through_drawn(open_: DataFrame, similarity: float) -> DataFrame:
    """Distinct pairs (a, b), a > b, of DRAWN lines of each open bucket with its lines of other components, so
    that hardly any pair of a family of similar lines is left."""
    line = F.struct("lid", "map", "root")
    drawn = open_.groupBy("band", "salts").agg(F.array(*(F.min_by(line, F.xxhash64("lid", F.lit(k))) for k in range(DRAWN))).alias("drawn"))
    chosen = drawn.select("band", "salts", F.explode(F.array_distinct("drawn")).alias("d")).select("band", "salts", F.col("d.lid").alias("x"), F.col("d.map").alias("map_x"), F.col("d.root").alias("root_x"))
    return _pair(_met(chosen, _named(open_, "y")).where("root_x <> root_y"), similarity).distinct()


def _left(open_: DataFrame) -> DataFrame:
    """Lines x outside the largest component of their bucket beside its lines y of other components, each pair once."""
    return _met(_named(open_, "x").where("rest_x"), _named(open_, "y")).where("root_x <> root_y AND (NOT rest_y OR x > y)")


def _close(open_: DataFrame, similarity: float) -> DataFrame:
    """(lid) of the lines of open buckets whose sketches agree with that of a line of another component; ``map``: a sketch.
    A line is kept as soon as it meets one such line; no pair is made, however many there are."""
    x, y, other = _named(open_, "x"), _named(open_, "y"), (F.col("root_x") != F.col("root_y")) & _may_agree("map_x", "map_y", similarity)
    beside = (_met(x.where("rest_x"), y, other), _met(x.where("NOT rest_x"), y.where("rest_y"), other))
    return reduce(DataFrame.unionAll, (lines.select(F.col("x").alias("lid")) for lines in beside)).distinct()


def _left_over(open_: DataFrame, similarity: float) -> DataFrame:
    """Distinct pairs (a, b), a > b, of open buckets.

    Every line outside its bucket's largest component meets every line of another component. Pairs
    inside one component can't change the result, so this is as good as all pairs of the bucket;
    maps rule out nearly all dissimilar pairs as they meet.
    """
    return _pair(_left(open_), similarity).distinct()


def _texts(docs: DataFrame, lids: DataFrame, turn: tuple[int, int] = (0, 1)) -> DataFrame:
    """(lid, line) of those of these distinct lines whose turn it is: (k, n), the k-th of n. ``docs``: documents, or a table of such rows."""
    k, n = turn
    of = lambda rows: rows.where(F.pmod("lid", F.lit(n)) == k) if n > 1 else rows
    lids = of(lids)
    few = lids.count() <= BROADCAST_LINES
    settled = "line" in docs.columns
    found = of(docs if settled else _lines(docs)).select("lid", "line").join(F.broadcast(lids) if few else lids, "lid", "left_semi")
    return found if settled else found.groupBy("lid").agg(F.first("line").alias("line"))


def _in_turns(scratch: Scratch, work: Callable[..., DataFrame], docs: DataFrame, lids: DataFrame) -> DataFrame:
    """Tables of ``work(docs, lids, turn)`` of every turn, one written after the other, as one."""
    n = max(1, min(TURNS, -(-lids.count() // BROADCAST_LINES)))
    parts = [scratch.cut(work(docs, lids, (k, n))) for k in range(n)]
    return reduce(DataFrame.unionAll, parts)


def _verified(docs: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    """A table of those pairs whose shingle sets have at least this Jaccard similarity."""
    with Scratch() as scratch:
        return cut(_similar(scratch, docs, pairs, similarity))


def _similar(scratch: Scratch, docs: DataFrame, pairs: DataFrame, similarity: float) -> DataFrame:
    lines = _in_turns(scratch, _texts, docs, scratch.cut(pairs.select(F.explode(F.array("a", "b")).alias("lid")).distinct()))
    beside = lambda rows, c: rows.join(lines.select(F.col("lid").alias(c), F.col("line").alias(f"line_{c}")), c)
    both = beside(beside(pairs, "a"), "b")
    sets = F.array(F.struct(F.array_distinct(_shingles("line_a")).alias("a"), F.array_distinct(_shingles("line_b")).alias("b")))
    alike = F.transform(sets, lambda s: F.struct(F.size(F.array_intersect(s["a"], s["b"])).alias("both"), (F.size(s["a"]) + F.size(s["b"])).alias("sizes")))
    counted = both.select("a", "b", F.inline(alike))
    return counted.where(F.col("both") >= similarity * (F.col("sizes") - F.col("both"))).select("a", "b")


def _links(scratch: Scratch, docs: DataFrame, shared: DataFrame, similarity: float, pairs_up_to: int) -> DataFrame:
    """Pairs of similar lines that connect all lines which similar pairs of shared buckets connect."""
    with Scratch() as own:
        links = scratch.hold(_verified(docs, own.cut(_candidates(shared, similarity, pairs_up_to)), similarity))
    large = shared.where(F.col("size") > pairs_up_to)
    if large.isEmpty():
        return links
    with Scratch() as own:
        open_ = _open(own, large, own.hold(components(links)))
        lids = own.cut(_close(open_, similarity))
        if lids.isEmpty():
            return links
        lines = _in_turns(own, _texts, docs, lids)
        maps = _in_turns(own, _maps, lines, lids)
        open_ = own.cut(open_.drop("map").join(maps, "lid"))
        for found in (_through_drawn, _left_over):
            pairs = own.cut(found(open_, similarity))
            if not pairs.isEmpty():
                links = links.unionAll(scratch.hold(_verified(lines, pairs, similarity)))
                if found is _through_drawn:
                    open_ = _open(own, open_, own.hold(components(links)))
    return links


def removed_lines(docs: DataFrame, *, similarity: float = SIMILARITY, pairs_up_to: int = PAIRS_UP_TO) -> DataFrame:
    """(doc, text_hash, removed) of each document that loses lines; ``removed``: their numbers from 0, in order."""
    docs = docs.select(F.col("doc_id").cast("bigint").alias("doc_id"), "text")
    with Scratch() as scratch:
        signed = scratch.cut(_signatures(docs))
        with Scratch() as own:
            roots = scratch.hold(components(_links(own, docs, _buckets(own, signed), similarity, pairs_up_to)))
        nodes = signed.join(roots, signed.lid == roots.node, "left").where("n > 1 OR root IS NOT NULL").select("lid", "doc", F.coalesce("root", "lid").alias("root"))
        least = nodes.groupBy("root").agg(F.min("doc").alias("least"))
        known = scratch.cut(nodes.select("lid", "root").join(least, "root"))
        places = scratch.cut(_lines(docs).select("lid", "doc", "text_hash", "number").join(known, "lid").select("root", "least", "doc", "text_hash", "number"))
        first = places.where("doc = least").groupBy("root").agg(F.min(F.struct("doc", "text_hash", "number")).alias("first"))
        gone = places.join(first, "root").where(F.struct("doc", "text_hash", "number") != F.col("first")).select("doc", "text_hash", "number")
        return cut(gone.groupBy("doc", "text_hash").agg(F.array_sort(F.collect_set("number")).alias("removed")))


def _with_removed(docs: DataFrame, removed: DataFrame) -> tuple[DataFrame, Column]:
    """``docs`` joined with the numbers of the lines to remove."""
    r = removed.select(*(F.col(c).alias(fresh(docs, f"{c}_r")) for c in removed.columns))
    doc, text_hash, numbers = (r[c] for c in r.columns)
    joined = docs.join(r, (F.coalesce(docs.doc_id, F.lit(LAST)) == doc) & (F.xxhash64(docs.text) == text_hash), "left")
    return joined, F.coalesce(numbers, F.array().cast("array<int>"))


def line_dedup(docs: DataFrame, **options) -> DataFrame:
    """One row per document: doc_id, n_lines (with a word), n_removed, removed (numbers from 0)."""
    counted = docs.select("doc_id", F.xxhash64("text").alias("text_hash"), F.size(F.filter(F.coalesce(F.split("text", "\n"), F.array()), lambda x: F.trim(x, F.lit(" \t\r\x0b\x0c")) != "")).cast("bigint").alias("n_lines"))
    r = removed_lines(docs, **options)
    joined = counted.join(r, (F.coalesce(counted.doc_id, F.lit(LAST)) == r.doc) & (counted.text_hash == r.text_hash), "left")
    gone = F.coalesce("removed", F.array().cast("array<int>"))
    return joined.select("doc_id", "n_lines", F.size(gone).cast("bigint").alias("n_removed"), gone.alias("removed"))


def keep_lines(docs: DataFrame, **options) -> DataFrame:
    """``docs`` without the removed lines; a document that has none left, but had some, goes.

    A column n_chars, where there is one, is counted anew for changed texts.
    """
    joined, gone = _with_removed(docs, removed_lines(docs, **options))
    lines = F.split(docs.text, "\n")
    rest = F.array_join(F.filter(lines, lambda x, i: ~F.array_contains(gone, i)), "\n")
    text = F.when(F.size(gone) > 0, rest).otherwise(docs.text)
    named = {"text": text, "n_chars": F.when(F.size(gone) > 0, F.length(text).cast(dict(docs.dtypes).get("n_chars", "bigint"))).otherwise(docs["n_chars"]) if "n_chars" in docs.columns else None}
    blank = (F.size(gone) > 0) & (F.trim(text, F.lit(" \t\r\n\x0b\x0c")) == "")
    return joined.where(~F.coalesce(blank, F.lit(False))).select(*(named[c].alias(c) if named.get(c) is not None else docs[c] for c in docs.columns))


def query(spark: SparkSession, sf_dir: str) -> DataFrame:
    """op2: the lines that every document loses."""
    return line_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet"))
