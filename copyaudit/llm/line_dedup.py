"""Line dedup: exact copies by hash, near copies by a segment-partition edit join.

Equal lines with a word are one node, whatever their length; two different lines of ``MIN_CHARS`` characters or more link
when their edit distance is at most ``MAX_EDITS``. The join stores each distinct line under its ``MAX_EDITS + 1`` segments
(length, segment number, segment text) and looks up, for every length it may match, only the substrings whose place is
possible for that length. A line within the distance shares at least one of them. Lines none of whose keys another line has
end there, after one aggregate over the keys. The letters of the others are counted, and pairs whose counts differ by more
than the edits allow are refused inside the join; the rest are verified by a banded bit-parallel edit distance. Linked
lines form classes (connected components), named by their first line in order of document and line number.

All of it is DataFrame code. Texts are shuffled once (the distinct lines); keys are hashes.

Defined cases: a null or empty text has no lines; blank lines never take part and stay; a line that occurs twice in a text is a copy too; equal rows (doc_id and text) are one document and keep the same lines; rows
that share a doc_id, or have none, with different texts are different documents, in order of the hash of their text;
a null doc_id comes before all others; other columns pass through ``drop_repeated_lines``; an empty table gives no rows.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from copyaudit.llm.common import WORD, components, kept, let, table, written

MAX_EDITS = 2
MIN_CHARS = 24
# Counted in lines that share a key, the most frequent first, so that each step reads a shorter rest of the line.
LETTERS = " enatirohsdlu.wbcfgmpvyk,éjqxz0123456789ABDEHILMOSTW"
TABLE_BITS = 24                       # bits, as a power of two, of the table of lines that share a key


def taking_part(line: Column, least_chars: int = MIN_CHARS) -> Column:
    return (F.length(line) >= least_chars) & (F.btrim(line, F.lit(" \t\n\x0b\f\r")) != "")


def text_hash(text: Column) -> Column:
    return F.xxhash64(F.coalesce(text, F.lit("")))


def line_rows(documents: DataFrame, least_chars: int = 1) -> DataFrame:
    """Rows ``(doc_id, doc_hash, line_no, id)`` of the lines that take part: hash of the text, place and hash of the line."""
    rows = documents.select("doc_id", text_hash(F.col("text")).alias("doc_hash"), F.posexplode(F.split(F.coalesce("text", F.lit("")), "\n")).alias("line_no", "line"))
    return rows.where(taking_part(F.col("line"), least_chars)).select("doc_id", "doc_hash", "line_no", F.xxhash64("line").alias("id"))


def long_lines(documents: DataFrame) -> DataFrame:
    """Rows ``(id, line)`` of the lines long enough for the edit join, each once per document."""
    rows = documents.select(F.explode(F.array_distinct(F.split(F.coalesce("text", F.lit("")), "\n"))).alias("line"))
    return rows.where(taking_part(F.col("line"))).select(F.xxhash64("line").alias("id"), "line")


def with_letters(lines: DataFrame) -> DataFrame:
    """Adds ``letters`` and ``twos``, the two low bits of the number of times that the line holds each letter of ``LETTERS``.

    Letters are counted by removing them one after the other.
    """
    names = F.array(*[F.lit(x) for x in LETTERS])

    def step(state, i):
        def counted(shorter):
            n = (F.length(state["rest"]) - F.length(shorter)).cast("long")
            bits = [F.call_function("shiftleft", F.shiftright(n, k).bitwiseAND(F.lit(1).cast("long")), i) for k in (0, 1)]
            return F.struct(shorter.alias("rest"), (state["letters"] + bits[0]).alias("letters"),
                            (state["twos"] + bits[1]).alias("twos"))

        return let(F.replace(state["rest"], F.get(names, i), F.lit("")), counted)

    zero = F.lit(0).cast("long")
    start = F.struct(F.col("line").alias("rest"), zero.alias("letters"), zero.alias("twos"))
    counts = F.aggregate(F.sequence(F.lit(0), F.lit(len(LETTERS) - 1)), start, step)
    return lines.withColumn("counts", counts).select(*lines.columns, "counts.letters", "counts.twos")


def _letters_fit(edits: int) -> Column:
    """Whether the letter counts of lines a and b allow ``edits`` edits.

    An edit that changes the length changes one count by one, another edit two; so with a difference d in length the counts
    differ by ``2 * edits - d`` at most. Of each difference the two low bits are known, which give its least size.
    """
    odd = F.col("letters_a").bitwiseXOR(F.col("letters_b"))
    two = F.col("twos_a").bitwiseXOR(F.col("twos_b")).bitwiseAND(F.bitwise_not(odd))
    return F.bit_count(odd) + 2 * F.bit_count(two) <= 2 * edits - F.abs(F.col("n_a") - F.col("n_b"))


def _segments(n: Column, count: int) -> list[tuple[Column, Column]]:
    """Start (from 1) and length of each of ``count`` segments of a line of ``n`` characters; the last ones are longer."""
    base, extra = F.floor(n / count).cast("int"), n % count
    out, start = [], F.lit(1)
    for i in range(count):
        length = base + (extra > count - 1 - i).cast("int")
        out.append((start, length))
        start = start + length
    return out


def _key(n: Column, i: int, line: Column, start: Column, length: Column) -> Column:
    return F.xxhash64(n, F.lit(i), F.substring(line, start, length))


def line_keys(line: Column, n: Column, edits: int) -> Column:
    """The segments of a line, and the substrings that can equal a segment of a line up to ``edits`` shorter, as numbers.

    The upper bits are the key, a hash; the lower ``TAIL`` ones are the kind. With d the difference in length, segment i
    (from 0) can only have moved by i to either side as seen from the left end and by ``edits - i`` as seen from the right
    end. A line's own segments stand for its lookups that have not moved, too.
    """
    keys = []
    for d in range(edits + 1):
        for i, (start, length) in enumerate(_segments(n - d, edits + 1)):
            for move in range(max(-i, d - (edits - i)), min(i, d + (edits - i)) + 1):
                kind = SHORTER if d else LOOKED if move else OWN
                key = _key(n - d, i, line, start + move, length)
                keys.append(F.shiftleft(F.shiftright(key, TAIL), TAIL) + F.lit(kind).cast("long"))
    return F.array(*keys)


OWN, LOOKED, SHORTER = 0, 1, 2        # a line's own segment, a lookup among lines of equal length, one among shorter lines
TAIL = 2


def without_common_ends(a: Column, b: Column) -> Column:
    """Struct (x, y) of two texts without equal beginnings and ends, cut by halves; their edit distance stays the same."""
    pair = F.struct(a.alias("x"), b.alias("y"))

    def cut(p, at_start):
        n = F.least(F.length(p["x"]), F.length(p["y"]))
        k = F.floor(n / 2).cast("int")

        def piece(text):
            return F.substring(text, F.lit(1), k) if at_start else F.right(text, k)

        def rest(text):
            return F.substring(text, k + 1, F.length(text) - k) if at_start \
                else F.substring(text, F.lit(1), F.length(text) - k)

        return F.when((n >= 16) & (piece(p["x"]) == piece(p["y"])), F.struct(rest(p["x"]).alias("x"), rest(p["y"]).alias("y"))) \
            .otherwise(p)

    for _ in range(4):
        pair = let(let(pair, lambda p: cut(p, True)), lambda p: cut(p, False))
    return pair


def banded_distance(a: Column, b: Column, edits: int = MAX_EDITS) -> Column:
    """Edit distance of two texts of ``edits`` characters or more, at most ``edits + 1``; code points.

    Bit t of the vectors is the row ``column - edits + t`` of the dynamic-programming matrix, so a band of ``2 * edits + 1``
    rows moves down the diagonal, one column per character of ``b``. VP and VN hold where the value grows or falls from
    the row above; the score follows the lowest diagonal, then the last row.
    """
    width, full = 2 * edits + 1, (1 << (2 * edits + 1)) - 1
    top = 1 << (width - 1)
    first_vp = sum(1 << t for t in range(width) if t >= edits)

    def run(pair):
        x, y = pair["x"], pair["y"]
        n = F.size(x)

        def step(s, j):
            char = F.get(y, j)
            match = F.lit(0)
            for t in range(width):
                match = match + F.when(F.get(x, j + (t - edits)) == char, F.lit(1 << t)).otherwise(F.lit(0))

            def moved(m):
                d0 = (m.bitwiseAND(s["vp"]) + s["vp"]).bitwiseXOR(s["vp"]).bitwiseOR(m).bitwiseOR(s["vn"]) \
                    .bitwiseAND(F.lit(full))
                return F.struct(d0.alias("d0"), F.bitwise_not(d0.bitwiseOR(s["vp"])).bitwiseOR(s["vn"])
                                .bitwiseAND(F.lit(full)).alias("hp"))

            def grown(v):
                d0, hp, hn = v["d0"], v["hp"], v["d0"].bitwiseAND(s["vp"])
                last = F.call_function("shiftleft", F.lit(1), F.greatest(n - j + (edits - 1), F.lit(0)))
                inside = n - j + (edits - 1) >= 0
                along = (inside & (hp.bitwiseAND(last) != 0)).cast("int") - (inside & (hn.bitwiseAND(last) != 0)).cast("int")
                score = s["score"] + F.when(j + (1 + edits) <= n, (d0.bitwiseAND(F.lit(top)) == 0).cast("int")).otherwise(along)
                down = F.shiftright(d0, 1)
                return F.struct(hn.bitwiseOR(F.bitwise_not(down.bitwiseOR(hp)).bitwiseAND(F.lit(full))).alias("vp"),
                                down.bitwiseAND(hp).alias("vn"), score.alias("score"))

            return let(let(match, moved), grown)

        start = F.struct(F.lit(first_vp).alias("vp"), F.lit(0).alias("vn"), F.lit(edits).alias("score"))
        return F.aggregate(F.sequence(F.lit(0), F.size(y) - 1), start, step, lambda s: F.least(s["score"], F.lit(edits + 1)))

    return F.when(F.abs(F.length(a) - F.length(b)) > edits, F.lit(edits + 1)).otherwise(
        let(let(without_common_ends(a, b), lambda p: F.struct(F.split(p["x"], "").alias("x"), F.split(p["y"], "").alias("y"))),
            run))


def _kind(key: str) -> Column:
    return F.col(key).bitwiseAND(F.lit((1 << TAIL) - 1))


def shared_keys(lines: DataFrame, edits: int = MAX_EDITS) -> DataFrame:
    """Rows ``(id, k)`` of the keys that different lines have, one of them as its own segment; linear in the keys."""
    keys = lines.select("id", F.explode(line_keys(F.col("line"), F.length("line"), edits)).alias("k")) \
        .repartition(F.shiftright("k", TAIL))
    # one shuffle serves both sides
    met = keys.groupBy(F.shiftright("k", TAIL).alias("key")) \
        .agg(F.min("id").alias("least"), F.max("id").alias("most"), F.min(_kind("k")).alias("kind")) \
        .where((F.col("least") != F.col("most")) & (F.col("kind") == OWN)).select("key")
    return keys.join(met.hint("shuffle_hash"), F.shiftright("k", TAIL) == F.col("key")).select("id", "k")


def candidate_pairs(shared: DataFrame, measured: DataFrame, edits: int = MAX_EDITS) -> DataFrame:
    """Pairs ``(a, b)`` of ids that share a key and have fitting letter counts; a below b, each pair once."""
    rows = kept(shared.join(measured.select("id", "n", "letters", "twos"), "id"))

    def side(x: str) -> DataFrame:
        return rows.select(*[F.col(c).alias(f"{c}_{x}") for c in ("id", "k", "n", "letters", "twos")])

    a, b = F.col("id_a"), F.col("id_b")
    possible = ((_kind("k_a") == SHORTER) | (a < b)) & (a != b) & _letters_fit(edits)
    return side("a").join(side("b").where(_kind("k_b") == OWN), F.shiftright("k_a", TAIL) == F.shiftright("k_b", TAIL)) \
        .where(possible).select(F.least(a, b).alias("a"), F.greatest(a, b).alias("b")).distinct()


def perhaps_in(lines: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose ``id`` has its bit set in a table of 2 ** TABLE_BITS bits: those with an id of ``ids`` and few others.

    The table is at most 2 ** TABLE_BITS / 64 rows, whatever the corpus, and goes to every task. Where it fills up, more
    lines pass; that changes no result.
    """
    place = F.col("id").bitwiseAND(F.lit((1 << TABLE_BITS) - 1))
    bit = F.call_function("shiftleft", F.lit(1).cast("long"), F.col("id").bitwiseAND(F.lit(63)).cast("int"))
    slots = ids.groupBy(F.shiftright(place, 6).alias("slot")).agg(F.bit_or(bit).alias("bits"))
    return lines.withColumn("slot", F.shiftright(place, 6)).join(F.broadcast(slots), "slot") \
        .where(F.col("bits").bitwiseAND(bit) != 0).select("id", "line")


def near_lines(lines: DataFrame, edits: int = MAX_EDITS) -> DataFrame:
    """Pairs ``(a, b)``, a below b, of ids of lines (as of ``long_lines``) within ``edits`` edits."""
    # a distinct without an aggregate function hashes the rows instead of sorting them
    shared = kept(shared_keys(lines.distinct(), edits))
    ids = shared.select("id").distinct()
    found = perhaps_in(lines, ids).distinct().join(ids, "id", "left_semi")
    measured = written(with_letters(found).withColumn("n", F.length("line")), "shared-lines")
    pairs = candidate_pairs(shared, measured, edits)
    for x in "ab":
        pairs = pairs.join(measured.select(F.col("id").alias(x), F.col("line").alias(f"line_{x}")), x)
    return pairs.where(banded_distance(F.col("line_a"), F.col("line_b"), edits) <= edits).select("a", "b")


def line_classes(documents: DataFrame, edits: int = MAX_EDITS, least_chars: int = MIN_CHARS) -> DataFrame:
    """Rows ``(doc_id, doc_hash, line_no, class_doc_id, class_doc_hash, class_line_no, n_links)`` of the lines that take part.

    These are lines of ``least_chars`` characters or more; those under ``MIN_CHARS`` have exact copies only. The class is
    named by its first line; ``n_links`` counts the different lines within ``edits`` of this one.
    """
    pairs = kept(near_lines(long_lines(documents), edits))
    # stored as Parquet and read by id: one order of the rows serves the first line of each class and the rows themselves
    rows = written(line_rows(documents, least_chars), "lines").repartition("id")
    first = rows.groupBy("id").agg(F.min(F.struct("doc_id", "doc_hash", "line_no")).alias("first"))
    degree = pairs.select(F.explode(F.array("a", "b")).alias("id")).groupBy("id").agg(F.count(F.lit(1)).alias("n_links"))
    linked = components(pairs).withColumnRenamed("node", "id").join(degree, "id")
    named = kept(linked.join(first, "id"))
    least = named.groupBy("component").agg(F.min("first").alias("class_first"))
    labels = named.join(least, "component").select("id", "class_first", "n_links")
    classes = first.join(labels, "id", "left").select(
        "id", F.coalesce("class_first", "first").alias("class"), F.coalesce("n_links", F.lit(0)).alias("n_links"))
    return rows.join(classes, "id").select("doc_id", "doc_hash", "line_no", F.col("class.doc_id").alias("class_doc_id"),
                                           F.col("class.doc_hash").alias("class_doc_hash"),
                                           F.col("class.line_no").alias("class_line_no"), "n_links")


def is_first() -> Column:
    return F.col("doc_id").eqNullSafe(F.col("class_doc_id")) & (F.col("doc_hash") == F.col("class_doc_hash")) \
        & (F.col("line_no") == F.col("class_line_no"))


def drop_repeated_lines(documents: DataFrame, edits: int = MAX_EDITS) -> DataFrame:
    """``documents`` without the lines that repeat an earlier one; texts that lose all their words are left out.

    All columns stay; ``n_chars``, if there, follows the new text.
    """
    columns = documents.columns
    dropped = kept(line_classes(documents, edits, least_chars=1).where(~is_first()).groupBy(F.col("doc_id").alias("drop_id"), F.col("doc_hash").alias("drop_hash"))
                   .agg(F.array_sort(F.collect_set("line_no")).alias("drop_lines")))
    places = dropped["drop_lines"]
    joined = documents.join(dropped, documents["doc_id"].eqNullSafe(dropped["drop_id"])
                            & (text_hash(documents["text"]) == dropped["drop_hash"]), "left")
    lines = F.split(documents["text"], "\n")
    text = F.when(places.isNull(), documents["text"]).otherwise(F.array_join(
        F.filter(lines, lambda _, i: ~F.array_contains(places, i)), "\n"))
    values = {"text": text}
    if "n_chars" in columns:
        values["n_chars"] = F.when(places.isNull(), documents["n_chars"]) \
            .otherwise(F.length(text).cast(documents.schema["n_chars"].dataType))
    emptied = places.isNotNull() & ~text.rlike(WORD)
    return joined.where(~emptied).select(*[values.get(c, documents[c]).alias(c) for c in columns])


def op6_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return line_classes(table(spark, sf_dir, "documents"), least_chars=1).select(
        "doc_id", F.col("line_no").cast("long").alias("line_no"), "class_doc_id",
        F.col("class_line_no").cast("long").alias("class_line_no"), F.col("n_links").cast("long").alias("n_links"),
        is_first().alias("kept"))
