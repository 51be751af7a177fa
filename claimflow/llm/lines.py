"""Near-duplicate lines by a segment-partition edit join.

Distinct lines are compared, copies only counted.  A line of length ``l`` is cut
into ``edits + 1`` segments; two lines within ``edits`` edits share at least one
segment of the shorter one, at a place that the lengths narrow down to a few
positions.  So the index holds each line's segments by (length, segment number,
text) and a line probes it with the few substrings that could match, for its
own and the next smaller lengths.  A line of many characters has fewer keys: its
first and its last characters, and some of its middle that a space there finds
again when they are shifted.  A line of a few characters, whose segments
would tell little, is found by what is left of it without any ``edits`` of its
characters: lines within reach share such a rest.  Lines that meet are confirmed
by a banded edit distance whose column is one machine word.  DataFrame functions only.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from claimflow.llm.components import components
from claimflow.llm.joins import lookup
from claimflow.llm.scratch import Scratch, scratch

EDITS = 2
SHORTEST = 1       # shorter lines are duplicates only when equal: none
BRIEF = 6          # lines of so many characters are found by their rests, longer ones by segments
LONG = 64          # lines of so many characters and more are found by their ends and middle
SPAN = 32          # lengths that long lines share their cuts with
ANCHOR = 16        # characters of the middle in which a space is looked for


# The parities of the characters at both ends of a line are compared before anything else.
WINDOW = 32        # characters of an end
CLASSES = 31       # classes of characters, by their hash


def odd(text: Column, classes: int) -> Column:
    """Whether a text holds an odd number of the characters of each class, a bit for each class."""
    return odd_parts(F.split(text, ""), lambda char: F.hash(char), classes)


def odd_parts(parts: Column, code, classes: int) -> Column:
    return F.aggregate(parts, F.lit(0).cast("long"), lambda bits, part: bits.bitwiseXOR(
        F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod(code(part), F.lit(classes)))))


def odd_twos(line: Column) -> Column:
    """As :func:`odd`, of two characters in a row: an edit takes two of them and brings two at most."""
    chars = F.split(line, "")
    twos = F.zip_with(chars, F.slice(chars, F.lit(2), F.size(chars)), lambda x, y: F.hash(x, y))
    return odd_parts(twos, lambda code: code, 2 * CLASSES)


def parities(line: Column) -> Column:
    """:func:`odd` of the first and the last ``WINDOW`` characters."""
    head, tail = F.substring(line, 1, WINDOW), F.substring(line, -WINDOW, WINDOW)
    return odd(head, CLASSES).bitwiseOR(F.shiftleft(odd(tail, CLASSES), CLASSES))


def alike(x: Column, y: Column, edits: int) -> Column:
    """An edit changes two parities of an end at most: one character comes, one goes, be it
    by a shift.  So each end of lines within reach differs by ``2 * edits``."""
    def near(bits: Column) -> Column:
        return F.bit_count(bits.bitwiseAND(F.lit((1 << CLASSES) - 1))) <= 2 * edits

    differ = x.bitwiseXOR(y)
    return near(differ) & near(F.shiftright(differ, CLASSES))


def index_kinds(edits: int) -> list[tuple[int, int, int]]:
    """(shorter, number, shift) of a line's own segments."""
    return [(0, k, 0) for k in range(1, edits + 2)]


def probe_kinds(edits: int) -> list[tuple[int, int, int]]:
    """(shorter, number, shift) of the substrings by which a line can meet lines of its own
    length or up to ``edits`` shorter.

    If segment k is the first that matches, each segment before it holds an edit,
    and so does, seen from the end, each one after it: that bounds how far the match
    is shifted from either side.
    """
    kinds = []
    for shorter in range(edits + 1):
        for k in range(1, edits + 2):
            before, after = k - 1, edits + 1 - k
            kinds += [(shorter, k, shift) for shift in range(max(-before, shorter - after),
                                                             min(before, shorter + after) + 1)]
    return kinds


def keyed(lines: DataFrame, kinds: list[tuple[int, int, int]], edits: int) -> DataFrame:
    """(id, parities, shorter, key): a row of each line (id, line, parities) for each kind.

    The key is that of segment ``number`` of a line that is ``shorter`` characters shorter,
    looked for ``shift`` characters further on.  The kinds are exploded before the keys are
    made, so that the compiled code makes one key, over and over, and stays small.
    """
    parts, (n, number) = edits + 1, (F.col("length"), F.col("kind.number"))
    rows = lines.select("id", "line", "parities", F.length("line").alias("length"), F.explode(F.array(*[
        F.struct(*[F.lit(v).alias(c) for c, v in zip(("shorter", "number", "shift"), kind, strict=True)])
        for kind in kinds])).alias("kind"))
    other = n - F.col("kind.shorter")
    short, first_long = F.floor(other / parts).cast("int"), parts - other % parts + 1  # from here on one more
    start = (number - 1) * short + F.greatest(number - first_long, F.lit(0)) + 1 + F.col("kind.shift")
    text = F.substring(F.col("line"), start, short + (number >= first_long).cast("int"))
    return rows.select("id", "parities", F.col("kind.shorter").alias("shorter"),
                       F.xxhash64(other, number, text).alias("key"))


def long_from(edits: int) -> int:
    """The least length of lines that have :func:`long_keys`, where a span begins."""
    return max(LONG, -(-(edits + 1) * (2 * edits + BRIEF) // SPAN) * SPAN)


def long_keys(lines: DataFrame, edits: int) -> DataFrame:
    """(id, key): the keys of long lines (id, line); two within ``edits`` edits share one.

    Lines of ``SPAN`` lengths, and of the next ``edits`` ones, are cut alike, as the shortest of
    them, into ``edits + 1`` segments; so a line may belong to two spans.  Unless the first or
    the last segment is the same, counted from its end, both hold an edit, and one between them
    is the same, shifted by ``edits - 1`` at most.  Its text is taken at every such shift.  It
    counts from its first space on, if that comes soon, so most shifts have one key.
    """
    n, parts, shift = F.length("line"), edits + 1, max(edits - 1, 0)
    own = F.floor(n / SPAN).cast("int")
    two = (n % SPAN < edits) & (n >= long_from(edits) + SPAN)
    spans = lines.select("id", "line", n.alias("n"), F.explode(
        F.when(two, F.array(own, own - 1)).otherwise(F.array(own))).alias("span"))
    cuts = spans.withColumn("cut", F.floor(F.col("span") * SPAN / parts).cast("int"))
    rows = cuts.withColumn("soon", F.least(F.floor(F.col("cut") / 2).cast("int") - shift, F.lit(ANCHOR)))
    line, span, cut, soon = (F.col(c) for c in ("line", "span", "cut", "soon"))

    def middle(k: int) -> Column:
        def key(by: Column) -> Column:
            start = cut * k + 1 + by
            space = F.locate(" ", F.substring(line, start, soon))
            size = cut - 2 * shift - F.when(space > 0, soon).otherwise(F.lit(0))
            return F.xxhash64(span, F.lit(k), F.substring(line, start + space, size))

        # one expression over the shifts: the JVM compiles no large method
        return F.transform(F.sequence(F.lit(0), F.lit(2 * shift)), key)

    ends = F.array(F.xxhash64(span, F.lit(0), F.substring(line, F.lit(1), cut)),
                   F.xxhash64(span, F.lit(edits), F.substring(line, F.col("n") - cut + 1, cut)))
    return rows.select("id", F.explode(F.array_distinct(F.concat(ends, *map(middle, range(1, edits))))).alias("key"))


def _let(value: Column, use) -> Column:
    """``use(value)``, the value computed once."""
    return F.get(F.transform(F.array(value), use), 0)


def common_prefix(a: Column, b: Column) -> Column:
    """Length of the longest common prefix, found by halving steps."""
    shorter = F.least(F.length(a), F.length(b))
    steps = F.transform(F.sequence(F.lit(0), F.ceil(F.log2(shorter + 1.0)).cast("int")),
                        lambda k: F.floor(F.pow(F.lit(2.0), F.ceil(F.log2(shorter + 1.0)) - k)).cast("int"))

    def longer(at: Column, step: Column) -> Column:
        same = F.substring(a, at + 1, step) == F.substring(b, at + 1, step)
        return F.when((at + step <= shorter) & same, at + step).otherwise(at)

    return F.aggregate(steps, F.lit(0), longer)


def within(a: Column, b: Column, edits: int) -> Column:
    """Whether two lines are within ``edits`` edits.

    What the lines have in common at both ends cannot matter and is left out; the
    rest is compared by :func:`_banded`.
    """
    def middle(head: Column) -> Column:
        return F.struct(F.substring(a, head + 1, F.length(a)).alias("a"), F.substring(b, head + 1, F.length(b)).alias("b"))

    def ends(m: Column) -> Column:
        def cut(tail: Column) -> Column:
            return _banded(F.substring(m["a"], F.lit(1), F.length(m["a"]) - tail),
                           F.substring(m["b"], F.lit(1), F.length(m["b"]) - tail), edits)

        return _let(common_prefix(F.reverse(m["a"]), F.reverse(m["b"])), cut)

    far = F.abs(F.length(a) - F.length(b)) > edits
    return F.when(a == b, F.lit(True)).when(far, F.lit(False)).otherwise(
        _let(common_prefix(a, b), lambda head: _let(middle(head), ends)))


def _banded(a: Column, b: Column, edits: int) -> Column:
    """Banded bit-parallel columns.

    Bit k of a column word is the row ``column - edits + k``.  ``up`` and ``down`` mark
    rows whose value is one more or one less than the row above; the value on the
    diagonal that ends in the last cell is carried along.  Once it is beyond
    ``edits`` the columns are skipped.
    """
    return _let(F.struct(F.split(a, "").alias("x"), F.split(b, "").alias("y"), F.length(a).alias("n"),
                         F.length(b).alias("m")), lambda t: _columns(t, edits))


def _columns(t: Column, edits: int) -> Column:
    x, y, n, m = t["x"], t["y"], t["n"], t["m"]
    width = 2 * edits + 1
    mask = (1 << width) - 1
    start = F.struct(F.lit(mask & ~((1 << edits) - 1)).cast("long").alias("up"), F.lit(0).cast("long").alias("down"),
                     F.greatest(n - m, F.lit(0)).cast("int").alias("value"))

    def column(state: Column, j: Column) -> Column:
        char = F.get(y, j - 1)
        equal = F.lit(0).cast("long")
        for k in range(width):
            row = j - edits + k
            equal = equal + F.when((row >= 1) & (F.get(x, F.greatest(row - 1, F.lit(0))) == char),
                                   F.lit(1 << k)).otherwise(F.lit(0)).cast("long")

        def moved(s: Column) -> Column:
            zero, up, down = s["zero"], s["up"], s["down"]
            right = down.bitwiseOR(F.bitwise_not(zero.bitwiseOR(up))).bitwiseAND(F.lit(mask))
            left = zero.bitwiseAND(up)
            shifted = F.shiftright(zero, 1)
            same = F.call_function("shiftright", zero, (n - m + edits).cast("int")).bitwiseAND(F.lit(1))
            return F.struct(
                left.bitwiseOR(F.bitwise_not(shifted.bitwiseOR(right))).bitwiseAND(F.lit(mask)).alias("up"),
                shifted.bitwiseAND(right).alias("down"),
                (s["value"] + 1 - same).cast("int").alias("value"))

        def zeros(s: Column) -> Column:
            eq, up, down = s["equal"], s["up"], s["down"]
            carried = (eq.bitwiseAND(up) + up).bitwiseXOR(up)
            return F.struct(carried.bitwiseOR(eq).bitwiseOR(down).bitwiseAND(F.lit(mask)).alias("zero"),
                            up.alias("up"), down.alias("down"), s["value"].alias("value"))

        met = F.struct(equal.alias("equal"), state["up"].alias("up"), state["down"].alias("down"),
                       state["value"].alias("value"))
        return F.when(state["value"] > edits, state).otherwise(_let(_let(met, zeros), moved))

    value = F.aggregate(F.sequence(F.lit(1), F.greatest(m, F.lit(1))), start, column, lambda s: s["value"])
    return F.when((n == 0) | (m == 0), n + m <= edits).otherwise(value <= edits)


def distinct_lines(docs: DataFrame, seed: int = 0) -> DataFrame:
    """(id, doc_id, line_no, line, copies, alone): each distinct non-empty line at its first place.

    The id is a hash of the line; ``alone`` is false where lines share one.
    """
    lines = docs.select("doc_id", F.posexplode(F.split(F.col("text"), "\n")).alias("line_no", "line"))
    other = F.xxhash64(F.lit(~seed), "line")
    return lines.filter("line <> ''").groupBy(F.xxhash64(F.lit(seed), "line").alias("id")).agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line_no")).alias("f"),
        F.first("line").alias("line"), F.count("*").alias("copies"), (F.min(other) == F.max(other)).alias("alone")).select(
        "id", "f.doc_id", "f.line_no", "line", "copies", "alone")


def named_lines(run: Scratch, docs: DataFrame, edits: int) -> DataFrame:
    """:func:`distinct_lines`, dealt by id, with the parities of those that are not long."""
    n, seed, long = F.length("line"), 0, long_from(edits)
    while True:
        named = run.stage_dealt(distinct_lines(docs, seed).withColumn(
            "parities", F.when(n < long + edits, parities(F.col("line")))), "lines", "id", "zstd")
        if not named.filter("NOT alone").limit(1).count():
            return named.drop("alone")
        seed += 1


def rests(line: Column, edits: int) -> Column:
    """What is left of a line without up to ``edits`` of its characters; the empty rest is left out."""
    def shorter(text: Column) -> Column:
        return F.when(F.length(text) > 1, F.transform(F.sequence(F.lit(1), F.length(text)), lambda k: F.concat(
            F.substring(text, F.lit(1), k - 1), F.substring(text, k + 1, F.length(text))))).otherwise(
            F.array().cast("array<string>"))

    out = F.array(line)
    for _ in range(edits):
        out = _let(out, lambda found: F.array_distinct(F.concat(found, F.flatten(F.transform(found, shorter)))))
    return out


def brief_pairs(lines: DataFrame, edits: int, brief: int) -> DataFrame:
    """(a, b) candidates, a < b, of which one has at most ``brief`` characters and one more than ``edits``."""
    short = lines.filter(F.length("line") <= brief + edits).select(
        "id", F.length("line").alias("length"), "parities",
        F.explode(rests(F.col("line"), edits)).alias("rest"))
    one = short.select(F.col("id").alias("a"), F.col("length").alias("n"), F.col("parities").alias("x"), "rest")
    two = short.select(F.col("id").alias("b"), F.col("length").alias("m"), F.col("parities").alias("y"),
                       F.col("rest").alias("same"))
    return one.join(two, (F.col("rest") == F.col("same")) & (F.col("a") < F.col("b"))
                    & (F.least("n", "m") <= brief) & (F.greatest("n", "m") > edits)
                    & (F.abs(F.col("n") - F.col("m")) <= edits) & alike(F.col("x"), F.col("y"), edits)).select("a", "b")


def long_pairs(run: Scratch, lines: DataFrame, edits: int) -> DataFrame:
    """(a, b) candidates, a < b, among the long lines (id, line).

    What a line holds is counted, as parities, only for lines that have a key in common with
    another one; it is compared inside the join, so that of many lines that are alike in one
    place no pairs are made.
    """
    keys = run.stage(long_keys(lines, edits), "keys")
    other = keys.select(F.col("id").alias("other"), F.col("key").alias("same"))
    shared = run.stage(keys.join(other, (F.col("key") == F.col("same")) & (F.col("id") != F.col("other")), "left_semi"),
                       "shared")
    held = run.stage(lines.select("id", "line").join(shared.select("id").distinct(), "id", "left_semi").select(
        "id", F.length("line").alias("n"), odd(F.col("line"), 2 * CLASSES).alias("ones"),
        odd_twos(F.col("line")).alias("twos")), "held")
    rows = shared.join(held, "id")
    one, two = (rows.select(F.col("id").alias(i), F.struct("n", "ones", "twos").alias(h), F.col("key").alias(k))
                for i, h, k in (("a", "x", "key"), ("b", "y", "same")))

    def apart(column: str) -> Column:
        return F.bit_count(F.col(f"x.{column}").bitwiseXOR(F.col(f"y.{column}")))

    return one.join(two, (F.col("key") == F.col("same")) & (F.col("a") < F.col("b"))
                    & (F.abs(F.col("x.n") - F.col("y.n")) <= edits) & (apart("ones") <= 2 * edits)
                    & (apart("twos") <= 4 * edits)).select("a", "b")


def edit_links(run: Scratch, lines: DataFrame, edits: int, shortest: int) -> DataFrame:
    """(a, b) ids of the lines (id, line, parities) that are within ``edits`` edits, a < b.

    Without those of two lines of at most ``edits`` characters, which are all
    within reach of each other.
    """
    length, brief, long = F.length("line"), max(BRIEF, edits), long_from(edits)
    mid = lines.filter((length >= shortest) & (length > brief) & (length < long + edits))
    index = keyed(mid, index_kinds(edits), edits).select(F.col("id").alias("a"), F.col("parities").alias("x"), "key")
    # one bit beyond the parities says that the probed length is the line's own
    probe = keyed(mid, probe_kinds(edits), edits).select(
        F.col("id").alias("b"), F.col("parities").bitwiseOR(
            F.shiftleft((F.col("shorter") == 0).cast("long"), 2 * CLASSES)).alias("y"), "key")
    # the parities are compared inside the join: what cannot match is no row of it
    once = (F.shiftright("y", 2 * CLASSES) == 0) | (F.col("a") < F.col("b"))
    met = index.join(probe, (index["key"] == probe["key"]) & (F.col("a") != F.col("b")) & once
                     & alike(F.col("x"), F.col("y"), edits))
    found = met.select(F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b")).unionByName(
        long_pairs(run, lines.filter((length >= shortest) & (length >= long)), edits)).unionByName(
        brief_pairs(lines.filter(length >= shortest), edits, brief))
    pairs = run.stage(found.distinct(), "pairs")
    ids = pairs.select(F.explode(F.array("a", "b")).alias("id")).distinct()
    # only the lines that met another one go on; of these the whole lines' parities are compared first
    texts = run.stage_texts(lines.select("id", "line").join(ids, "id", "left_semi").withColumn(
        "odd", odd(F.col("line"), 2 * CLASSES)), "met")
    one = pairs.join(texts.select(F.col("id").alias("a"), F.col("line").alias("x"), F.col("odd").alias("p")), "a")
    two = one.join(texts.select(F.col("id").alias("b"), F.col("line").alias("y"), F.col("odd").alias("q")), "b")
    near = F.bit_count(F.col("p").bitwiseXOR(F.col("q"))) <= 2 * edits
    return run.stage(two.filter(F.when(near, within(F.col("x"), F.col("y"), edits)).otherwise(F.lit(False)))
                     .select("a", "b"), "links")


def near_lines(run: Scratch, docs: DataFrame, edits: int = EDITS, shortest: int = SHORTEST) -> DataFrame:
    """One row per distinct line: where it is first, its copies, links and class.

    ``doc_id``, ``line_no`` (from 0): the first place of the line, smallest id first, a
    null id last; ``copies``: lines that are equal; ``links``: other distinct lines
    within ``edits`` edits; ``class_doc_id``, ``class_line_no``: the first place of the
    smallest line, in the order of places, that links reach; ``kept``: the line is that
    line.  Lines end at line feeds; empty lines are no lines, nor are null texts.
    Lines of fewer than ``shortest`` characters are linked with nothing.  Other
    columns are not read.
    """
    # texts are shuffled once; the smallest place of a class is found by the place itself
    named = named_lines(run, docs, edits)
    links = edit_links(run, named, edits, shortest)
    both = links.unionByName(links.select(F.col("b").alias("a"), F.col("a").alias("b")))
    # the shortest lines are all linked with each other: counted, and tied to one of them, not paired
    tiny = run.stage(named.filter(F.length("line").between(shortest, edits)).select("id"), "tiny")
    size = tiny.agg(F.count("*").alias("n"), F.min("id").alias("first")).first()
    others = tiny.filter(F.lit(size["n"] > 1)).select("id", F.lit(size["n"] - 1).cast("long").alias("links"))
    degree = run.stage(both.groupBy("a").agg(F.count("*").alias("links")).withColumnRenamed("a", "id")
                       .unionByName(others).groupBy("id").agg(F.sum("links").alias("links")), "degree")
    ties = tiny.select(F.lit(size["first"]).cast("long").alias("a"), F.col("id").alias("b"))
    roots = components(run, links.unionByName(ties)).select(F.col("node").alias("id"), "root")
    linked = run.stage(degree.join(roots.unionByName(
        roots.select(F.col("root").alias("id"), "root").distinct()).distinct(), "id")
        .join(named.select("id", "doc_id", "line_no"), "id"), "linked")
    first = run.stage(linked.groupBy("root").agg(
        F.min(F.struct(F.col("doc_id").isNull().alias("none"), "doc_id", "line_no")).alias("f"),
        F.count("*").alias("n")).select("root", F.col("f.doc_id").alias("class_doc_id"),
                                        F.col("f.line_no").alias("class_line_no"), "n"), "first")
    classed = lookup(linked.select("id", "links", "root"), first, ["root"], "n").drop("root")
    out = named.drop("line", "parities").join(classed, "id", "left")
    alone = F.col("links").isNull()
    return out.select(
        "doc_id", "line_no", "copies", F.coalesce("links", F.lit(0)).cast("long").alias("links"),
        F.when(alone, F.col("doc_id")).otherwise(F.col("class_doc_id")).alias("class_doc_id"),
        F.when(alone, F.col("line_no")).otherwise(F.col("class_line_no")).alias("class_line_no")).withColumn(
        "kept", F.col("doc_id").eqNullSafe(F.col("class_doc_id")) & (F.col("line_no") == F.col("class_line_no")))


def op7_near_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every distinct line of all documents with its class."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch(spark) as run:
        return run.result(near_lines(run, docs), "op7")
