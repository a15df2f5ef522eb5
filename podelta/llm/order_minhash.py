"""Order MinHash fingerprints (operator 6), in DataFrame functions only.

Every k-mer (k neighbouring words) is numbered by its occurrence within the text and hashed with that number, which places it
on a circle of hashes.  Each part of the fingerprint has a starting point of its own on that circle, so its own order of all
k-mers: its least ones are the first at or after its starting point.  They are put in the order of the text and hashed as one tuple.
A part is equal in two texts if both select the same k-mers, in the same order, wherever in the text these stand, so
likeness falls with edit distance, not only with the set of k-mers: moved blocks change about half of all pairs.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from podelta.llm.common import bind, stage

WORDS = 5  # words of a k-mer
PARTS = 32  # parts of a fingerprint
TUPLE = 2  # k-mers of a part

PLACE_BITS = 31  # of a circle entry: the k-mer's place in its text, below the first 33 bits of its hash


def _at(array: Column, j: Column) -> Column:
    """Entry at place ``j`` from 0, null outside."""
    return F.get(array, j)


def word_array(text: Column) -> Column:
    """Words of a text (cut at space and 0x09-0x0D); null counts as empty."""
    spaced = F.coalesce(text, F.lit(""))
    for c in "\t\n\x0b\x0c\r":
        spaced = F.replace(spaced, F.lit(c), F.lit(" "))
    return F.filter(F.split(spaced, " "), lambda w: w != "")


def _room(array: Column) -> Column:
    """The power of two above the array's size."""
    return F.call_function("shiftleft", F.lit(1).cast("bigint"), F.length(F.bin(F.size(array))))


def _packed(kmers: Column) -> Column:
    """K-mer hashes with their places in the low bits, sorted: equal k-mers form runs in the order of the text.

    Within one text a k-mer is told from others by the bits above its place, 40 of them in a text of 16 million words.
    """
    return bind(_room(kmers), lambda r: F.sort_array(F.transform(kmers, lambda h, p: h.bitwiseAND(-r).bitwiseOR(p))))


def _entry(kmer: Column, place: Column) -> Column:
    """Circle entry of a k-mer hash at a place: sorting entries sorts by hash."""
    return kmer.bitwiseAND(F.lit(-(1 << PLACE_BITS))).bitwiseOR(place.cast("bigint"))


def _steps(n: Column) -> Column:
    """Powers of two up to ``n``, falling: the steps of a search by halving in ``n`` entries."""
    return F.filter(F.array(*(F.lit(1 << b) for b in range(30, -1, -1))), lambda step: step <= n)


def _numbered_entries(kmers: Column, packed: Column) -> Column:
    """Circle entries of the numbered k-mers of a text with repeated k-mers, in no order.

    In ``packed`` an entry that continues the run before it is a repeat; a first one keeps the hash of its k-mer, each repeat
    gets a hash of its k-mer and its number.
    """

    def select(room: Column) -> Column:
        repeat = lambda x, j: F.coalesce(_at(packed, j - 1).bitwiseAND(-room) == x.bitwiseAND(-room), F.lit(False))
        place = lambda x: x.bitwiseAND(room - 1).cast("int")
        kmer = lambda x: F.coalesce(_at(kmers, place(x)), F.lit(0).cast("bigint"))
        heads = F.transform(F.filter(packed, lambda x, j: ~repeat(x, j)), lambda x: _entry(kmer(x), place(x)))

        def number(again: Column) -> Column:
            runs = F.transform(again, lambda x: x.bitwiseAND(-room))

            def halving(r: Column, j: Column) -> Column:  # entries before j that equal it, for long lists
                return F.aggregate(_steps(F.size(r)), F.lit(0),
                                   lambda n, step: F.when((step <= j - n) & (_at(r, j - n - step) == _at(r, j)), n + step).otherwise(n))

            return bind(runs, lambda r: F.transform(again, lambda x, j: _entry(F.xxhash64(
                kmer(x), F.when(F.size(r) <= 512, j - F.array_position(r, _at(r, j)).cast("int") + 1).otherwise(halving(r, j)) + 1), place(x))))

        return F.concat(heads, bind(F.filter(packed, repeat), number))

    return bind(_room(packed), select)


def _tuples(circle: Column, steps: Column, parts: int, size: int) -> Column:
    """One tuple hash per starting point: the next ``size`` entries of the sorted circle, in the order of the text."""
    n = F.size(circle)
    starts = F.array(*(F.lit(-(1 << 63) + i * ((1 << 64) // parts)).cast("bigint") for i in range(parts)))
    by_place = lambda x: F.shiftleft(x, 64 - PLACE_BITS).bitwiseOR(F.shiftrightunsigned(x, PLACE_BITS))
    hash_bits = lambda x: x.bitwiseAND(F.lit((1 << (64 - PLACE_BITS)) - 1))

    def part(start: Column) -> Column:
        before = F.aggregate(steps, F.lit(0), lambda lo, step: F.when(
            (lo + step <= n) & (_at(circle, lo + step - 1) < start), lo + step).otherwise(lo))
        chosen = lambda i: F.array(*(F.when(F.lit(j) < n, by_place(_at(circle, (i + j) % n))) for j in range(size)))
        return bind(before, lambda i: F.xxhash64(F.transform(F.array_sort(F.array_compact(chosen(i))), hash_bits)))

    return F.when(n > 0, F.transform(starts, part)).otherwise(F.array().cast("array<bigint>"))


def with_parts(df: DataFrame, text: Column, name: str = "parts", k: int = WORDS, parts: int = PARTS, size: int = TUPLE) -> DataFrame:
    """``df`` and its fingerprints: array columns of ``parts`` longs.

    A text of fewer words than ``k`` is one k-mer, a text without words has no parts; of fewer k-mers than ``size`` all form
    every part.  Every step that is used more than once is a column, so that it is computed once, by generated code.
    """
    c = lambda step: F.col(f"__{name}_{step}")
    step = lambda frame, title, value: frame.withColumn(f"__{name}_{title}", value)
    kept_columns = [F.col(f"`{x}`") for x in df.columns if x != name]
    out = step(df, "words", F.transform(word_array(text), lambda w: F.xxhash64(w)))
    n = F.size(c("words"))
    starts = F.slice(c("words"), F.lit(1), F.greatest(n - (k - 1), F.lit(0)))
    windows = F.transform(starts, lambda w, i: F.xxhash64(w, *(_at(c("words"), i + j) for j in range(1, k))))
    short = F.filter(F.array(F.xxhash64(c("words"))), lambda _: n > 0)
    out = step(out, "kmers", F.when(n >= k, windows).otherwise(short))
    # Texts without a repeated k-mer, most of them, need no numbers.
    repeats = F.size(F.array_distinct(c("kmers"))) != F.size(c("kmers"))
    out = step(out, "packed", F.when(repeats, _packed(c("kmers"))))
    entries = F.when(c("packed").isNotNull(), _numbered_entries(c("kmers"), c("packed"))).otherwise(F.transform(c("kmers"), _entry))
    out = step(out, "circle", F.sort_array(entries))
    out = step(out, "steps", _steps(F.size(c("circle"))))
    return out.select(*kept_columns, _tuples(c("circle"), c("steps"), parts, size).alias(name))


def render(fingerprint: Column) -> Column:
    """Parts as 16 hexadecimal digits each, comma-joined; empty for a text without words."""
    return F.array_join(F.transform(fingerprint, lambda x: F.lower(F.lpad(F.hex(x), 16, "0"))), ",")


def likeness(a: Column, b: Column) -> Column:
    """Share of the parts that are equal in both fingerprints; 1 for two texts without words."""
    parts = F.greatest(F.size(a), F.size(b))
    equal = F.filter(F.zip_with(a, b, lambda x, y: x == y), lambda same: same)
    return F.when(parts == 0, F.lit(1.0)).otherwise(F.size(equal) / parts)


def fingerprint(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """``key`` and ``parts`` (array of longs) per input row.

    Null text counts as empty (no parts), null keys stay, repeated rows are done one by one, an empty table gives no rows;
    other columns are neither read nor returned.  Equal texts have equal fingerprints.
    """
    return with_parts(docs.select(F.col(key).alias("key"), F.col(text).alias("text")), F.col("text"), "parts", **options).select(
        F.col("key").alias(key), "parts")


# --- comparison with an edited text --------------------------------------------
def successors(keys: DataFrame, key: str) -> DataFrame:
    """(key, rows, next): how many rows have the key, and the next distinct key in descending order, the greatest after the
    least; null orders last.

    Only keys are moved: they are range-partitioned and sorted, and a table of one row per partition joins the ends.
    """
    ranged = (keys.groupBy(F.col(key).alias("key")).agg(F.count(F.lit(1)).alias("rows"))
              .repartitionByRange(F.col("key").desc_nulls_last()).sortWithinPartitions(F.col("key").desc_nulls_last()))
    placed = stage(ranged.select("key", "rows", F.spark_partition_id().alias("part")), "keys")
    order = F.col("key").desc_nulls_last()
    inside = placed.select("key", "rows", "part", F.lead(F.struct("key")).over(Window.partitionBy("part").orderBy(order)).alias("next"))
    first = F.max_by(F.struct("key"), F.struct(F.col("key").isNotNull(), F.col("key")))
    heads = stage(placed.groupBy("part").agg(first.alias("head")), "heads")  # one row per partition
    after = heads.select(F.col("part"), F.lead("head").over(Window.orderBy("part")).alias("lead"),
                         F.first("head").over(Window.orderBy("part")).alias("top"))
    ends = F.coalesce("next", "lead", "top")
    return inside.join(F.broadcast(after), "part").select("key", "rows", ends["key"].alias("next"))


def compare_with_edits(docs: DataFrame, key: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """Per row: n_chars, the edited text, the fingerprints of both, and likeness to the edited and to the next text.

    The edited text is the text with its last floor(n/2) code points replaced by the first as many (or all) of the next
    document's, in descending key order, and after the last the first.  Rows that repeat a key share their next document,
    the next smaller distinct key; of rows that repeat that key the least text counts.  A lone key is its own next.
    """
    rows = docs.select(F.struct(F.col(key).alias("key")).alias("at"), F.coalesce(F.col(text), F.lit("")).alias("text"))
    order = stage(successors(docs.select(F.col(key).alias("key")), "key")
                  .select(F.struct("key").alias("at"), "rows", F.struct(F.col("next").alias("key")).alias("to")), "successors")
    # Keys of several rows, as a table of known size.  Their least text is an aggregate, reduced before the shuffle.
    repeated = stage(order.where("rows > 1").select("at"), "repeated")
    least = rows.join(repeated, "at", "left_semi").groupBy("at").agg(F.min("text").alias("text"))
    least = with_parts(least, F.col("text"), "parts", **options).select(F.col("at").alias("to"), F.struct("text", "parts").alias("least"))
    rows = with_parts(rows, F.col("text"), "parts", **options)  # a struct key also joins null to null
    chars = F.length("text")
    half = F.floor(chars / 2).cast("int")
    # Both joins of rows and order share one shuffle of the rows.
    heads = rows.join(order, "at").select("to", F.struct(
        F.col("at.key").alias("key"), chars.cast("bigint").alias("n_chars"), half.alias("half"),
        F.substring("text", F.lit(1), chars - half).alias("head"), F.col("parts").alias("parts")).alias("doc"))
    only = rows.join(order.where("rows = 1").select("at"), "at").select(F.col("at").alias("to"), F.struct("text", "parts").alias("only"))
    following = heads.join(only, "to", "left").join(least, "to", "left").select("doc", F.coalesce("only", "least").alias("after"))
    joined = following.select(
        F.col("doc.key").alias(key), F.col("doc.n_chars").alias("n_chars"), F.col("doc.parts").alias("parts"),
        F.concat("doc.head", F.substring("after.text", F.lit(1), F.col("doc.half"))).alias("edited_text"),
        F.col("after.parts").alias("next_parts"))
    return (with_parts(joined, F.col("edited_text"), "edited_parts", **options)
            .withColumn("near_edited", likeness(F.col("parts"), F.col("edited_parts")))
            .withColumn("near_next", likeness(F.col("parts"), F.col("next_parts"))))
