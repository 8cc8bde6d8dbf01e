"""Document fingerprints by one-permutation MinHash.

Every shingle is hashed once. The upper bits of a hash name its bin, and the
least hash of a bin stands for it. Empty bins borrow from others by optimal
densification: each has a fixed random order of all bins and takes the first that
is not empty. Of every bin the lowest bits are stored, packed into hexadecimal
digits; bits that agree by chance are taken out of the likeness.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cratemark.llm.storage import stored

SHINGLE = 5
BINS_LOG2 = 7
# Bits stored of a bin: two hexadecimal digits.
BITS = 8
WORD_GAP = r"[\x20\x09-\x0D]+"


def _let(value: Column, use) -> Column:
    """``use(value)`` with the value worked out once."""
    return F.transform(F.array(value), use)[0]


def _bin(value: Column, bins_log2: int) -> Column:
    return F.shiftrightunsigned(value, 64 - bins_log2)


def _hashes(text: Column, shingle: int) -> Column:
    """Hashes of the shingles of a text, in order, with repeats; words are hashed
    first, and shingles from those. A shorter text is one shingle."""

    def combine(h: Column) -> Column:
        last = F.size(h) - shingle
        return F.when(
            last >= 0,
            F.transform(
                F.sequence(F.lit(0), F.greatest(last, F.lit(0))),
                lambda i: F.xxhash64(*[F.get(h, i + k) for k in range(shingle)]),
            ),
        ).otherwise(F.array(F.xxhash64(F.array_join(F.transform(h, lambda x: x.cast("string")), " "))))

    words = F.filter(F.split(text, WORD_GAP), lambda w: w != "")
    return _let(
        F.transform(words, lambda w: F.xxhash64(w)),
        lambda h: F.when(F.size(h) > 0, combine(h)).otherwise(F.array().cast("array<bigint>")),
    )


def _minima(hashes: Column, bins_log2: int) -> Column:
    """The least hash of every bin that is not empty, by bin. Sorted, the hashes
    of a bin are neighbours, and the first of them is the least."""

    def first_of_bin(s: Column) -> Column:
        return F.filter(
            s,
            lambda x, i: (i == 0)
            | (_bin(x, bins_log2) != _bin(F.get(s, i - 1), bins_log2)),
        )

    return _let(F.sort_array(hashes), first_of_bin)


def _digits(value: Column) -> Column:
    """The stored bits of a hash, as text."""
    return F.lower(F.substring(F.lpad(F.hex(value), 16, "0"), 17 - BITS // 4, BITS // 4))


def fingerprint(text: Column, shingle: int = SHINGLE, bins_log2: int = BINS_LOG2) -> Column:
    """The fingerprint of a text (null counts as empty) as hexadecimal digits:
    ``BITS`` bits for each of ``2**bins_log2`` bins. A text without words has an
    empty one."""
    bins = F.sequence(F.lit(0), F.lit((1 << bins_log2) - 1)).cast("array<bigint>")

    def fill(m: Column) -> Column:
        held = F.map_from_arrays(F.transform(m, lambda x: _bin(x, bins_log2)), m)

        def borrow(b: Column) -> Column:
            # Bins in the order of bin b: the first that is held has the least
            # of these numbers.
            order = F.transform(
                m,
                lambda x: F.struct(
                    F.xxhash64(b, _bin(x, bins_log2)).alias("place"), x.alias("hash")
                ),
            )
            return F.array_min(order)["hash"]

        def value(known: Column) -> Column:
            return F.array_join(
                F.transform(
                    bins, lambda b: _digits(F.coalesce(F.element_at(known, b), borrow(b)))
                ),
                "",
            )

        return _let(held, value)

    return _let(
        _minima(_hashes(F.coalesce(text, F.lit("")), shingle), bins_log2),
        lambda m: F.when(F.size(m) > 0, fill(m)).otherwise(F.lit("")),
    )


def likeness(one: Column, other: Column) -> Column:
    """Estimated resemblance of the shingle sets behind two fingerprints, 0 to 1:
    the share of bins that agree, less those that agree by chance. Two empty
    fingerprints are alike, an empty one is like no other."""
    width = BITS // 4
    size = F.length(one) / width
    places = F.sequence(F.lit(0), F.greatest(F.lit(0), size.cast("int") - 1))
    agree = F.size(
        F.filter(
            places,
            lambda i: F.substring(one, i * width + 1, F.lit(width))
            == F.substring(other, i * width + 1, F.lit(width)),
        )
    )
    chance = 1.0 / (1 << BITS)
    return (
        F.when(one == other, 1.0)
        .when((F.length(one) == 0) | (F.length(other) == 0), 0.0)
        .otherwise(F.greatest(F.lit(0.0), (agree / size - chance) / (1 - chance)))
    )


# --- a document and the next one --------------------------------------------------


def _next_rows(slim: DataFrame) -> DataFrame:
    """From (row, id): (row, id, next), the row that follows by id, the first after
    the last. Ids are dealt out in ranges, so that no task sees them all; between
    ranges, the first row of each suffices."""
    ranged = stored(
        slim.repartitionByRange("id", "row").withColumn("range", F.spark_partition_id()),
        "fingerprint-order",
    )
    by_id = Window.partitionBy("range").orderBy(F.col("id").asc_nulls_first(), "row")
    numbered = ranged.withColumn("next", F.lead("row").over(by_id))
    # One row a range: few, whatever the number of documents.
    firsts = ranged.groupBy("range").agg(
        F.min_by("row", F.struct(F.col("id").isNotNull(), "id", "row")).alias("first")
    )
    following = firsts.select(
        F.col("range").alias("_range"),
        F.coalesce(
            F.lead("first").over(Window.orderBy("range")),
            F.min_by("first", "range").over(Window.partitionBy()),
        ).alias("following"),
    )
    return numbered.join(
        F.broadcast(following), F.col("range") == F.col("_range")
    ).select("row", "id", F.coalesce("next", "following").alias("next"))


def fingerprints_with_edits(
    docs: DataFrame, text_col: str = "text", id_col: str = "doc_id",
    shingle: int = SHINGLE, bins_log2: int = BINS_LOG2,
) -> DataFrame:
    """Per row of ``docs``: id, n_chars, fingerprint, edited_sha256,
    edited_fingerprint, near_edited and near_next.

    The edited text has the last quarter of the code points (rounded down)
    replaced by as many from the start of the next document by id, or by all it
    has; the first document follows the last. ``near_*`` is the likeness to the
    fingerprint of the edited text, and to that of the next document.

    Nulls: a null text is empty; rows without an id come before all others. Rows
    with the same id follow one another in any, but a fixed, order. A single row
    is its own next. An empty table gives no rows. Only the columns named are read.
    """
    base = stored(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            docs[id_col].alias("id"),
            F.coalesce(docs[text_col], F.lit("")).alias("text"),
        ),
        "fingerprint-documents",
    )
    sizes = base.select(F.col("row").alias("_row"), F.length("text").alias("n_chars"))
    order = stored(
        _next_rows(base.select("row", "id"))
        .join(sizes, F.col("row") == F.col("_row"))
        .select("row", "id", "next", "n_chars", F.floor(F.col("n_chars") / 4).cast("int").alias("cut")),
        "fingerprint-next",
    )
    # What each document lends to the one before it. Both joins deal the texts
    # out alike, by row, so Spark shuffles them once.
    lender, borrower = base.select("row", "text").alias("lender"), base.select("row", "text").alias("borrower")
    lent = lender.join(order.alias("o"), F.col("lender.row") == F.col("o.next")).select(
        F.col("o.row").alias("to"),
        F.col("o.id").alias("id"),
        F.col("o.n_chars").cast("long").alias("n_chars"),
        "cut",
        F.expr("left(lender.text, cut)").alias("lent"),
    )
    edited = F.concat(F.expr("left(text, n_chars - cut)"), F.col("lent"))
    found = stored(
        borrower.join(lent, F.col("borrower.row") == F.col("to"))
        .select("row", "id", "n_chars", "text", edited.alias("edited"))
        .select(
            "row",
            "id",
            "n_chars",
            fingerprint(F.col("text"), shingle, bins_log2).alias("fingerprint"),
            F.sha2("edited", 256).alias("edited_sha256"),
            fingerprint(F.col("edited"), shingle, bins_log2).alias("edited_fingerprint"),
        ),
        "fingerprint-found",
    )
    following = found.select(F.col("row").alias("_next"), F.col("fingerprint").alias("_next_fp"))
    return (
        found.join(order.select(F.col("row").alias("_row"), "next"), F.col("row") == F.col("_row"))
        .join(following, F.col("next") == F.col("_next"))
        .select(
            F.col("id").alias(id_col),
            "n_chars",
            "edited_sha256",
            "fingerprint",
            "edited_fingerprint",
            likeness(F.col("fingerprint"), F.col("edited_fingerprint")).alias("near_edited"),
            likeness(F.col("fingerprint"), F.col("_next_fp")).alias("near_next"),
        )
    )
