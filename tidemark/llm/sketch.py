"""Document fingerprints: invertible Bloom lookup sketches of paragraphs. DataFrame functions only.

A text's paragraphs are its lines, each cut every ``WORDS`` words, white space between words as it is; their digests (XXH64, without
repeats) are the elements. A sketch has three thirds of cells; an element belongs to one cell of each. A
cell holds the number of its elements, the exclusive or of their digests and that of their check hashes.
A third's size is the least power of two, ``LEAST_THIRD`` or more, that is one and a half times the paragraphs, so it
depends on the text alone. The fingerprint is that sketch in hex: the size's exponent, then each filled cell with half its check hash.

Two fingerprints of one size subtract cell by cell. If sizes differ, the smaller one's elements (it gives them all out
when peeled alone) are placed at the larger size. Peeling goes through the thirds in turn: a cell that holds
one element of either version gives its digest out, and it is removed from its three cells, until all are
empty: the digests are exactly the paragraphs by which the versions differ. Pairs that keep filled
cells are retried with four times the cells and other hashes, until none is left, ``ATTEMPTS`` times at most; what still
fails (about one in 10 ** 12) is counted from the digests themselves.

Cells are rows (document, code of pair, size and cell): only filled ones exist, and each step is an
aggregation by document, whose rows lie together already, so that no step shuffles. The work is
proportional to the paragraphs, however long a text is.

The likeness of two texts is 1 - d / u for d differing paragraphs and u paragraphs of either (1 if
neither has any). Both follow from the two fingerprints: the counts of a third's cells add up to the paragraphs.

Null texts count as empty. The next document is that with the next larger (doc_id, hash of the text), null
first; the last one's is the first. A single document is its own next. Equal rows (doc_id and text)
count as one document there, and give a row each. No rows give no rows. Other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import text_of
from tidemark.session import write_scratch

WORDS = 16
LEAST_THIRD = 32
ATTEMPTS = 5
STEPS = 8
KEY = ["_id", "_hash"]

# A cell's code: the pair (two bits), the exponent of a third's size (six bits), the cell (56 bits). The cell after the
# last counts the elements given out.
EDITED, NEXT, OWN_PRINT, EDITED_PRINT = range(4)


def paragraphs(text: Column) -> Column:
    """Digests of a text's paragraphs, without repeats."""
    piece = r"(?:[^\x20\x09-\x0D]++[\x20\x09\x0B-\x0D]*+){1,%d}+" % WORDS
    found = F.regexp_extract_all(text, F.lit(piece), F.lit(0))
    return F.array_distinct(F.transform(found, lambda p: F.xxhash64(F.rtrim(p, F.lit(" \t\x0b\x0c\r")))))


# ---- sketches as rows --------------------------------------------------------------


def code_of(pair: int, exponent: Column) -> Column:
    """The code of a sketch's first cell."""
    return F.shiftleft(F.lit(pair).cast("long"), 62).bitwiseOR(F.shiftleft(exponent.cast("long"), 56))


def pair_in(code: Column) -> Column:
    return F.shiftrightunsigned(code, 62)


def exponent_in(code: Column) -> Column:
    return F.shiftrightunsigned(code, 56).bitwiseAND(F.lit(63)).cast("int")


def third_in(code: Column) -> Column:
    return F.call_function("shiftleft", F.lit(1).cast("long"), exponent_in(code))


def cell_in(code: Column) -> Column:
    return code.bitwiseAND(F.lit((1 << 56) - 1))


def exponent_for(paragraphs: Column) -> Column:
    """Of the size of a third that a text with so many paragraphs has."""
    least = F.greatest(paragraphs * F.lit(1.5), F.lit(float(LEAST_THIRD)))
    return F.ceil(F.log2(least)).cast("int")


def check(key: Column, salt: int) -> Column:
    return F.xxhash64(key, F.lit(salt))


def places(checked: Column, third: Column) -> list[Column]:
    """An element's cell in each third, from its check hash."""
    parts = [checked, F.shiftrightunsigned(checked, 32), F.xxhash64(checked)]
    return [p.bitwiseAND(third - 1) + third * i for i, p in enumerate(parts)]


def elements(pair: int, exponent: Column, mine: str, other: str | None) -> Column:
    """Array of an element's digest, its sign, and the code of its sketch's first cell."""
    base = code_of(pair, exponent)

    def signed(digests: str, sign: int) -> Column:
        return F.transform(digests, lambda d: F.struct(d.alias("key"), F.lit(sign).alias("n"), base.alias("base")))

    return signed(mine, 1) if other is None else F.concat(signed(mine, 1), signed(other, -1))


def summed(cells: DataFrame) -> DataFrame:
    """Cells added up; empty ones go."""
    sums = cells.groupBy(*KEY, "code").agg(
        F.sum("n").alias("n"), F.bit_xor("key").alias("key"), F.bit_xor("check").alias("check")
    )
    return sums.filter("n != 0 or key != 0")


def sketched(rows: DataFrame, parts: list[Column], salt: int) -> DataFrame:
    """The cells of the elements in ``parts``, arrays as of :func:`elements`."""
    each = rows.select(*KEY, F.explode(F.concat(*parts)).alias("e")).select(*KEY, "e.*")
    each = each.withColumn("check", check(F.col("key"), salt))
    codes = [F.col("base") + c for c in places(F.col("check"), third_in(F.col("base")))]
    return summed(each.select(*KEY, F.explode(F.array(*codes)).alias("code"), "n", "key", "check"))


def peeled(cells: DataFrame, salt: int) -> DataFrame:
    """The cells after ``STEPS`` steps of peeling."""
    for step in range(STEPS):
        code, key, n = F.col("code"), F.col("key"), F.col("n")
        third = third_in(code)
        # In one third an element has one cell, so it is given out once.
        pure = (F.abs(n) == 1) & (F.call_function("shiftright", cell_in(code), exponent_in(code)) == step % 3)
        pure = pure & (check(key, salt) == F.col("check"))
        base = code - cell_in(code)

        def cell(code: Column, n: Column, key: Column, checked: Column) -> Column:
            return F.struct(code.alias("code"), n.cast("long").alias("n"), key.alias("key"), checked.alias("check"))

        zero = F.lit(0).cast("long")
        own = cell(code, n, key, F.col("check"))
        gone = [cell(base + c, -n, key, F.col("check")) for c in places(F.col("check"), third)]
        counted = cell(base + third * 3, F.lit(1), zero, zero)
        moved = F.when(pure, F.array(own, counted, *gone)).otherwise(F.array(own))
        cells = summed(cells.select(*KEY, F.explode(moved).alias("c")).select(*KEY, "c.*"))
    return cells


def written(exponent: Column, cells: Column) -> Column:
    """A sketch as hex: exponent;cell:n:key:check,... by cell."""
    texts = F.transform(
        F.array_sort(cells),
        lambda c: F.concat_ws(
            ":", F.hex(c["cell"]), F.hex(c["n"]), F.lpad(F.hex(c["key"]), 16, "0"), F.lpad(F.hex(c["check"]), 8, "0")
        ),
    )
    return F.concat_ws(";", F.lower(F.hex(exponent)), F.lower(F.array_join(texts, ",")))


def printed(rows: DataFrame) -> DataFrame:
    """keys, own_print, edited_print of rows with keys and digests, which lie together by keys."""
    pairs = ((OWN_PRINT, "digests", "own_print"), (EDITED_PRINT, "edited_digests", "edited_print"))
    parts = [elements(pair, exponent_for(F.size(digests)), digests, None) for pair, digests, _ in pairs]
    code = F.col("code")
    shown = F.struct(cell_in(code).alias("cell"), "n", "key", F.shiftrightunsigned("check", 32).alias("check"))
    columns = []
    for pair, _, name in pairs:
        mine = pair_in(code) == pair
        columns.append(written(F.max(F.when(mine, exponent_in(code))), F.collect_list(F.when(mine, shown))).alias(name))
    return sketched(rows, parts, 1).groupBy(*KEY).agg(*columns)


def outcome(cells: DataFrame) -> DataFrame:
    """Per document and pair: d, the elements given out, and left, the cells still filled."""
    pair = pair_in(F.col("code"))
    given = cell_in(F.col("code")) == third_in(F.col("code")) * 3
    columns = []
    for name, which in (("edited", EDITED), ("next", NEXT)):
        columns.append(F.sum(F.when((pair == which) & given, F.col("n"))).alias(f"d_{name}"))
        columns.append(F.count(F.when((pair == which) & ~given, 1)).alias(f"left_{name}"))
    return cells.groupBy(*KEY).agg(*columns)


def compared(rows: DataFrame) -> DataFrame:
    """keys, d_edited, d_next of rows with keys and digests."""

    def pairs(attempt: int) -> list[Column]:
        return [
            elements(pair, exponent_for(F.greatest(F.size("digests"), F.size(other))) + 2 * attempt, "digests", other)
            for pair, other in ((EDITED, "edited_digests"), (NEXT, "next_digests"))
        ]

    def redone(known: DataFrame, new: DataFrame) -> DataFrame:
        """``known`` with the d and left of ``new`` where cells were left."""
        names = [f"{c}_{n}" for c in ("d", "left") for n in ("edited", "next")]
        both = known.join(new.select(*KEY, *(F.col(c).alias(f"new_{c}") for c in names)), KEY, "left")
        mine = [
            F.when(F.col(f"left_{c.split('_')[1]}") > 0, F.col(f"new_{c}")).otherwise(F.col(c)).alias(c) for c in names
        ]
        return both.select(*KEY, *mine)

    # The documents of a task stay in it through all steps.
    tasks = int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    rows = rows.select(*KEY, "digests", "edited_digests", "next_digests")
    failures = F.expr("left_edited > 0 or left_next > 0")
    known = write_scratch(outcome(peeled(sketched(rows.repartition(tasks, *KEY), pairs(0), 1), 1)), "sketch-outcome")
    for attempt in range(1, ATTEMPTS):
        failed = known.filter(failures).select(*KEY)
        if failed.isEmpty():
            return known
        cells = sketched(rows.join(failed, KEY, "left_semi").repartition(tasks, *KEY), pairs(attempt), attempt + 1)
        known = redone(known, write_scratch(outcome(peeled(cells, attempt + 1)), "sketch-outcome"))
    last = rows.join(known.filter(failures).select(*KEY), KEY, "left_semi")
    counts = []
    for name in ("edited", "next"):
        apart = [F.array_except("digests", f"{name}_digests"), F.array_except(f"{name}_digests", "digests")]
        counts += [(F.size(apart[0]) + F.size(apart[1])).cast("long").alias(f"d_{name}")]
        counts += [F.lit(0).cast("long").alias(f"left_{name}")]
    return redone(known, last.select(*KEY, *counts))


def likeness(differ: Column, mine: Column, other: Column) -> Column:
    """1 - d / u; u is half of both sizes and of what differs."""
    union = (mine + other + differ) / F.lit(2.0)
    return F.when(union > 0, 1.0 - differ / union).otherwise(F.lit(1.0))


# ---- versions ----------------------------------------------------------------------


def keyed(docs: DataFrame) -> DataFrame:
    """Key columns without nulls, and text."""
    text = text_of(docs)
    doc_id = docs["doc_id"].cast("long")
    return docs.select(
        F.coalesce(doc_id, F.lit(0)).alias("_id"),
        F.xxhash64(text, doc_id.isNull()).alias("_hash"),
        text.alias("text"),
        doc_id.alias("doc_id"),
    )


def predecessors(docs: DataFrame) -> DataFrame:
    """Of each document its key, doc_id, copies, and its predecessor's key and half length.

    Documents are dealt to ranges of keys; only a range's last row goes to the next range's first.
    """
    ids = keyed(docs).groupBy(*KEY).agg(
        F.count("*").alias("copies"), F.max(F.length("text")).alias("n"), F.max("doc_id").alias("doc_id")
    )
    order = [F.asc_nulls_first("doc_id"), F.asc("_hash")]
    dealt = write_scratch(ids.repartitionByRange(*order).withColumn("_range", F.spark_partition_id()), "sketch-order")
    one = F.struct(*KEY, "n")
    inside = Window.partitionBy("_range").orderBy(*order)
    rank = F.struct(F.col("doc_id").isNotNull(), "doc_id", "_hash", one.alias("one"))
    # One row per range.
    lasts = dealt.groupBy("_range").agg(F.max(rank).getField("one").alias("last"))
    by_range = Window.orderBy("_range")
    everywhere = by_range.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = lasts.select(
        "_range", F.coalesce(F.lag("last").over(by_range), F.last("last").over(everywhere)).alias("before")
    )
    return (
        dealt.withColumn("_before", F.lag(one).over(inside))
        .join(F.broadcast(ends), "_range")
        .withColumn("_before", F.coalesce("_before", "before"))
        .select(
            *KEY,
            "doc_id",
            "copies",
            F.col("_before._id").alias("p_id"),
            F.col("_before._hash").alias("p_hash"),
            F.floor(F.col("_before.n") / 2).cast("int").alias("p_half"),
        )
    )


def versions(docs: DataFrame) -> DataFrame:
    """Key, doc_id, copies, text, edited, and the digests of both and of the next document."""
    one = Window.partitionBy(*KEY).orderBy(*KEY)
    # Both uses below take the same columns of this, so that texts are shuffled once.
    texts = keyed(docs).select(*KEY, "text", paragraphs(F.col("text")).alias("digests"))
    once = texts.withColumn("_nth", F.row_number().over(one)).filter("_nth = 1").drop("_nth")
    before = predecessors(docs)
    given = once.join(before.select(*KEY, "p_id", "p_hash", "p_half"), KEY).select(
        F.col("p_id").alias("_id"),
        F.col("p_hash").alias("_hash"),
        F.substring("text", F.lit(1), F.col("p_half")).alias("head"),
        F.col("digests").alias("next_digests"),
    )
    both = once.join(before.select(*KEY, "doc_id", "copies"), KEY).join(given, KEY)
    half = F.floor(F.length("text") / 2).cast("int")
    edited = F.concat(F.substring("text", F.lit(1), F.length("text") - half), F.col("head"))
    return both.withColumn("edited", edited).withColumn("edited_digests", paragraphs(F.col("edited")))


def fingerprints(docs: DataFrame) -> DataFrame:
    """doc_id, n_chars, edited_sha256, fingerprint, edited_fingerprint, near_edited, near_next."""
    rows = versions(docs).select(
        *KEY,
        "doc_id",
        "copies",
        F.length("text").cast("long").alias("n_chars"),
        F.sha2("edited", 256).alias("edited_sha256"),
        "digests",
        "edited_digests",
        "next_digests",
    )
    rows = write_scratch(rows, "sketch-digests")
    known = compared(rows).select(*KEY, "d_edited", "d_next")
    size = {c: F.size(f"{c}digests").alias(f"{c}size") for c in ("", "edited_", "next_")}
    tasks = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    prints = printed(rows.select(*KEY, "digests", "edited_digests").repartition(tasks, *KEY))
    plain = rows.select(*KEY, "doc_id", "copies", "n_chars", "edited_sha256", *size.values())
    # Documents without paragraphs have no cells.
    found = plain.repartition(tasks, *KEY).join(known, KEY, "left").join(prints, KEY, "left")
    zero = F.lit(0).cast("long")
    d_edited, d_next = F.coalesce("d_edited", zero), F.coalesce("d_next", zero)
    none = written(exponent_for(F.lit(0)), F.array().cast("array<struct<cell:long,n:long,key:long,check:long>>"))

    def print_of(column: str) -> Column:
        # A text without paragraphs has an empty sketch, whatever the other version has.
        return F.when(F.col("size" if column == "own_print" else "edited_size") > 0, F.col(column)).otherwise(none)

    return found.select(
        "doc_id",
        "n_chars",
        "edited_sha256",
        print_of("own_print").alias("fingerprint"),
        print_of("edited_print").alias("edited_fingerprint"),
        likeness(d_edited, F.col("size"), F.col("edited_size")).alias("near_edited"),
        likeness(d_next, F.col("size"), F.col("next_size")).alias("near_next"),
        F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies"))).alias("_copy"),
    ).drop("_copy")
