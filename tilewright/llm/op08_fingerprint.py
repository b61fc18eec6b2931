"""Document fingerprints by Order MinHash, in DataFrame functions only.

A text's k-mers are runs of ``K`` words, each numbered by its occurrence in the text, so that a repeated
k-mer counts as often as it stands; a text whose words are very long, as without white space, has runs of
``K_CHARS`` code points instead. Each of ``ENTRIES`` hash functions puts the numbered k-mers into one order and
takes two of them, its smallest and its largest (the smallest of the reversed order); the two, in the order in
which they stand in the text, are hashed to one entry of the signature. Two texts agree in an entry if they
share these k-mers and their order, which is what makes the signature follow the edit distance rather than the
mere sets. (The two smallest of one order are as good a sample of two, but no aggregate function gives them.)

K-mers of a text are built and numbered in arrays of 64-bit values (the upper 33 bits of a hash, 31 bits of
place, as many as an array can have), and the extremes are taken by an aggregation over the exploded array,
which Spark compiles. A single exchange deals out the documents in blocks of consecutive ids and about
``BLOCK_BYTES``, in which the next document, its text and its fingerprint are found by windows; a block's first
document is sent to the block before, too.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ._shared import table

K, ENTRIES = 2, 64
#: Code points of a k-mer of a text with fewer than one word in LONG_WORD code points.
K_CHARS, LONG_WORD = 6, 32
#: Bytes of texts in a block, and a bound for the number of blocks, whose first ids the driver holds.
BLOCK_BYTES, MOST_BLOCKS = 16 << 20, 20_000
_BITS = 31
_PLACE = (1 << _BITS) - 1
_WORDS = "[\\x20\\x09-\\x0D]+"


def _let(value: Column, then: Callable[[Column], Column]) -> Column:
    """``then(value)``, with ``value`` computed once however often it is used."""
    return F.element_at(F.transform(F.array(value), then), 1)


def _tagged(h: Column, place: Column) -> Column:
    return h.bitwiseAND(F.lit(~_PLACE)).bitwiseOR(place)


def numbered_kmers(text: Column, k: int = K) -> Column:
    """Array of long: for each k-mer a hash of it and of its occurrence number, tagged with its place.

    A text of fewer than ``k`` words is one k-mer, a text without words has none, and one of long words has runs
    of ``K_CHARS`` code points. The first occurrence has the k-mer's own hash.
    """

    def runs(w: Column, k: int) -> Column:
        shifted = [F.slice(w, j + 1, F.greatest(F.size(w) - k + 1, F.lit(0))) for j in range(k)]
        if k == 2:
            return F.zip_with(*shifted, lambda x, y: F.xxhash64(x, y))
        return F.transform(shifted[0], lambda x, i: F.xxhash64(x, *[F.get(w, i + j) for j in range(1, k)]))

    def of_words(w: Column) -> Column:
        n = F.size(w)
        chars = _let(F.split(text, ""), lambda c: runs(c, K_CHARS))
        return F.when((n > 0) & (F.length(text) > LONG_WORD * n), chars).when(n >= k, runs(w, k)).when(n > 0, F.array(F.xxhash64(F.array_join(w, " ")))).otherwise(F.array().cast("array<bigint>"))

    def of_sorted(s: Column) -> Column:
        again = F.filter(s, lambda x, i: F.coalesce(F.shiftright(x.bitwiseXOR(F.get(s, i - 1)), _BITS) == 0, F.lit(False)))
        return _let(again, lambda d: F.when(F.size(d) == 0, s).otherwise(F.concat(F.array_except(s, d), of_repeated(d))))

    def of_repeated(d: Column) -> Column:
        """Each one's number is its distance from the first of its run, found by a prefix maximum in log steps, and 1."""
        begins = F.transform(d, lambda x, i: F.when(F.shiftright(x.bitwiseXOR(F.get(d, i - 1)), _BITS) == 0, F.lit(0)).otherwise(i))
        rounds = F.sequence(F.lit(0), F.ceil(F.log2(F.size(d) + 1)).cast("int"))
        first = F.aggregate(rounds, begins, lambda b, t: F.transform(b, lambda x, i: F.greatest(x, F.coalesce(F.get(b, i - F.pow(F.lit(2), t).cast("int")), F.lit(0)))))
        return _let(first, lambda f: F.transform(d, lambda x, i: _tagged(F.xxhash64(F.shiftright(x, _BITS), i - F.get(f, i) + 1), x.bitwiseAND(F.lit(_PLACE)))))

    words = F.filter(F.split(text, _WORDS), lambda w: w != "")
    tagged = _let(_let(words, of_words), lambda h: F.sort_array(F.transform(h, lambda x, i: _tagged(x, i.cast("long")))))
    return _let(tagged, of_sorted)


def order_minhash(rows: DataFrame, keys: list[str], kmers: str = "kmers", entries: int = ENTRIES) -> DataFrame:
    """(keys, kmers) to (keys, sig): ``entries`` longs. Keys must tell rows apart."""
    v = F.col("v")
    placed = [_tagged(F.xxhash64(F.shiftright(v, _BITS), F.lit(j)), v.bitwiseAND(F.lit(_PLACE))) for j in range(entries)]
    least = rows.select(*keys, F.explode_outer(kmers).alias("v")).groupBy(*keys).agg(*[f(c).alias(f"{n}{j}") for j, c in enumerate(placed) for n, f in (("a", F.min), ("b", F.max))])
    sig = []
    for j in range(entries):
        a, b = F.col(f"a{j}"), F.col(f"b{j}")
        x, y = F.shiftright(a, _BITS), F.shiftright(b, _BITS)
        turned = a.bitwiseAND(F.lit(_PLACE)) > b.bitwiseAND(F.lit(_PLACE))
        sig.append(F.when(a.isNull(), F.xxhash64(F.lit(j))).when(turned, F.xxhash64(y, x, F.lit(j))).otherwise(F.xxhash64(x, y, F.lit(j))))
    return least.select(*keys, F.array(*sig).alias("sig"))


def likeness(a: Column, b: Column) -> Column:
    """Share of equal entries."""
    return F.aggregate(F.zip_with(a, b, lambda x, y: (x == y).cast("double")), F.lit(0.0), lambda s, x: s + x) / F.size(a)


def as_text(sig: Column) -> Column:
    """Eight hexadecimal digits for each entry."""
    return F.array_join(F.transform(sig, lambda x: F.lower(F.substring(F.hex(F.lit(1 << 62).bitwiseOR(x.bitwiseAND(F.lit((1 << 62) - 1)))), 9, 8))), "")


def _blocks(ids: DataFrame, ord_: Column, n: int) -> tuple[Column, Column, Column]:
    """For ``n`` blocks of consecutive ids: a row's block, whether its id is its block's first, and the block before.

    The driver gets n bounds and the blocks' first ids, nothing that grows with the rows.
    """
    at = [k / n for k in range(1, n)] or [0.5]
    got = ids.agg(F.percentile_approx(ord_, at, max(10_000, 20 * n)).alias("b")).first()[0]
    bounds = sorted(set(got or []))
    step = max(1, int(len(bounds) ** 0.5))
    array = lambda xs: F.array(*map(F.lit, xs)).cast("array<bigint>")
    coarse = F.size(F.filter(array(bounds[::step]), lambda b: b <= ord_))
    block = _let(coarse, lambda c: F.when(c == 0, F.lit(0)).otherwise((c - 1) * step + F.size(F.filter(F.slice(array(bounds), (c - 1) * step + 1, F.lit(step)), lambda b: b <= ord_)))).cast("int")
    firsts = sorted((r.block, r.first) for r in ids.select(block.alias("block"), ord_.alias("o")).groupBy("block").agg(F.min("o").alias("first")).collect())
    first_of, before = [None] * (len(bounds) + 1), [0] * (len(bounds) + 1)
    for k, (b, first) in enumerate(firsts):
        first_of[b], before[b] = first, firsts[k - 1][0]
    return block, F.coalesce(F.get(array(first_of), block) == ord_, F.lit(False)), F.get(array(before), block).cast("int")


def fingerprints(docs: DataFrame) -> DataFrame:
    """One row for each row of ``docs``: doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next.

    The next document is the one with the next doc_id, after the last the first; rows of equal doc_id are
    ordered by their texts' hashes, then their texts, and a null doc_id comes first. A table of one row
    is its own next. A null text counts as empty; columns besides doc_id and text are ignored.
    """
    spark = docs.sparkSession
    size = docs.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    n = min(MOST_BLOCKS, max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-size // BLOCK_BYTES)))
    text = F.coalesce(F.col("text"), F.lit(""))
    order = F.coalesce(F.col("doc_id"), F.lit(-(1 << 63))).cast("long")
    block, is_first, before = _blocks(docs.select("doc_id"), order, n)
    rows = docs.select("doc_id", text.alias("text"), order.alias("o"), block.alias("block"), is_first.alias("is_first"), before.alias("before"))
    places = F.when(F.col("is_first"), F.array(F.struct(F.col("block").alias("b"), F.lit(0).alias("guest")), F.struct(F.col("before").alias("b"), F.lit(1).alias("guest"))))
    rows = rows.select("doc_id", "text", "o", F.explode(F.coalesce(places, F.array(F.struct(F.col("block").alias("b"), F.lit(0).alias("guest"))))).alias("p"))
    rows = rows.select(F.col("p.b").alias("block"), F.col("p.guest").alias("guest"), "doc_id", "o", "text", F.xxhash64("text").alias("h"))
    rows = rows.repartitionById(n, F.col("block"))
    in_block = Window.partitionBy("block").orderBy("guest", "o", "h", "text")
    rows = rows.withColumn("n_chars", F.length("text").cast("long"))
    rows = rows.withColumn("k", F.floor(F.col("n_chars") / 4).cast("int"))
    rows = rows.withColumns({"place": F.row_number().over(in_block), "next": F.lead("text").over(in_block)})
    edited = F.concat(F.substring(F.col("text"), F.lit(1), (F.col("n_chars") - F.col("k")).cast("int")), F.substring(F.coalesce("next", F.lit("")), F.lit(1), F.col("k")))
    rows = rows.select("block", "place", "guest", "doc_id", "n_chars", "text", edited.alias("edited"))
    keys = ["block", "place", "guest", "doc_id", "n_chars", "edited_sha256", "which"]
    versions = [F.struct(F.lit(k).alias("which"), F.coalesce(c, F.lit("")).alias("t")) for k, c in enumerate(("text", "edited"))]
    both = F.explode(F.when(F.col("guest") == 0, F.array(*versions)).otherwise(F.array(versions[0])))
    rows = rows.withColumn("edited_sha256", F.sha2("edited", 256)).select(*keys[:-1], both.alias("x"))
    rows = rows.select(*keys[:-1], F.col("x.which").alias("which"), numbered_kmers(F.col("x.t")).alias("kmers"))
    sigs = order_minhash(rows, keys)
    sigs = sigs.groupBy(*keys[:-1]).agg(F.max(F.when(F.col("which") == 0, F.col("sig"))).alias("sig"), F.max(F.when(F.col("which") == 1, F.col("sig"))).alias("edited_sig"))
    sigs = sigs.withColumn("next_sig", F.lead("sig").over(Window.partitionBy("block").orderBy("guest", "place"))).where("guest = 0")
    return sigs.select(
        "doc_id", "n_chars", "edited_sha256", as_text(F.col("sig")).alias("fingerprint"), as_text(F.col("edited_sig")).alias("edited_fingerprint"),
        likeness(F.col("sig"), F.col("edited_sig")).alias("near_edited"), likeness(F.col("sig"), F.col("next_sig")).alias("near_next"),
    )


def op8_order_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return fingerprints(table(spark, sf_dir, "documents"))
