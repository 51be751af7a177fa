"""Phrase collocations by counting quotient filters.

Words get numbers, n-grams of numbers are counted in quotient filters (see
:mod:`quotient`), one order after the other: tasks count the n-grams of their part
of the corpus, cut their filter by shard and each shard's filters are merged.  An
n-gram that occurs ``least`` times consists of shorter ones that do, so a task
counts only windows whose two shorter windows may be frequent; which ones may be
is told by a bit set of fixed size that every frequent n-gram is in.  The counts
of what passes are exact, so nothing is lost at any size.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimflow.llm import quotient
from claimflow.llm.digests import DigestArray, Published, digest, publish
from claimflow.llm.joins import lookup
from claimflow.llm.scratch import Scratch, scratch
from claimflow.llm.words import mix, text_bytes

LEAST = 100            # occurrences of a candidate
LONGEST = 5            # words of a candidate
PER_LANG = 2000        # phrases reported
SLICE = 1 << 19        # bytes of text hashed at once
WORDS = 1 << 21        # words, n-grams or counters that a task holds at once, about
SHARD = 1 << 22        # n-gram occurrences of a shard, about
LEAST_SHARD_BITS = 8
SET_BITS = 27          # of the bit set of frequent n-grams: 16 MB
SPREAD = 64            # parts that rank a language's phrases before the last ranking

_KIND = np.zeros(256, np.uint8)           # 0 a byte of a word, 1 between words, 2 between pieces
_KIND[[9, 32]] = 1
_KIND[list(b".,;:!?\n\x0b\x0c\r")] = 2
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32
_VALUES = np.random.Generator(np.random.PCG64(412)).integers(1, 1 << 63, 256, dtype=np.uint64) * np.uint64(2) + np.uint64(1)
_BASE = np.uint64(0xD6E8FEB86659FD93)


def _powers(n: int) -> np.ndarray:
    out = np.full(n, _BASE, np.uint64)
    out[0] = 1
    return np.multiply.accumulate(out)


_POWERS = _powers(64)


class Words:
    """Some words of a column, in order."""

    def __init__(self, hashes: np.ndarray, pieces: np.ndarray, starts: np.ndarray, sizes: np.ndarray,
                 docs: np.ndarray, data: np.ndarray):
        self.hashes, self.pieces = hashes, pieces    # the piece of text that a word is in
        self.starts, self.sizes = starts, sizes      # its bytes in ``data``, which is lower-cased
        self.docs, self.data = docs, data


def words_of(texts: pa.Array, langs: np.ndarray) -> Iterator[Words]:
    """The words of a column, about ``SLICE`` bytes at a time.

    ``langs``: a 64-bit value for each text; equal words of different languages have
    different hashes.  Pieces are numbered across the slices of the column.
    """
    data, offsets = text_bytes(texts)
    at, end, piece = int(offsets[0]), int(offsets[-1]), 0
    while at < end:
        to = _cut(data, at, end)
        found = _words(data[at:to], offsets[(offsets >= at) & (offsets < to)] - at, piece)
        piece = found.pieces_after
        docs = np.searchsorted(offsets, found.starts + at, "right") - 1
        if len(docs):
            yield Words(mix(found.hashes ^ langs[docs]), found.pieces, found.starts, found.sizes, docs, found.data)
        at = to


def _cut(data: np.ndarray, at: int, end: int) -> int:
    """Where a slice may end: after a byte between words."""
    if end - at <= SLICE:
        return end
    between = np.flatnonzero(_KIND[data[at:at + SLICE]])
    if len(between):
        return at + int(between[-1]) + 1
    for lo in range(at + SLICE, end, SLICE):
        between = np.flatnonzero(_KIND[data[lo:min(lo + SLICE, end)]])
        if len(between):
            return lo + int(between[0]) + 1
    return end


class _Found:
    def __init__(self, **values):
        self.__dict__.update(values)


def _words(data: np.ndarray, texts: np.ndarray, piece: int) -> _Found:
    data = _LOWER[data]
    kind = _KIND[data]
    inside, breaks = kind == 0, kind == 2
    begins, ends = inside.copy(), inside.copy()
    begins[1:] &= ~inside[:-1]
    ends[:-1] &= ~inside[1:]
    breaks[texts] = True
    begins[texts] |= inside[texts]
    before = texts[texts > 0] - 1
    ends[before] |= inside[before]
    numbers = np.cumsum(breaks) + piece
    starts = np.flatnonzero(begins)
    sizes = np.flatnonzero(ends) - starts + 1
    held = data[inside]
    first = np.cumsum(sizes) - sizes
    hashes = np.zeros(0, np.uint64)
    if len(starts):
        place = np.arange(len(held)) - np.repeat(first, sizes)
        longest = int(sizes.max())
        powers = _POWERS if longest <= len(_POWERS) else _powers(longest)
        hashes = mix(np.add.reduceat(_VALUES[held] * powers[place], first) + sizes.astype(np.uint64))
    return _Found(hashes=hashes, pieces=numbers[starts], starts=starts, sizes=sizes, data=data,
                  pieces_after=int(numbers[-1]))


def _lang_values(langs: pa.Array) -> tuple[np.ndarray, list[str]]:
    """A 64-bit value per row of a column of languages, and the languages themselves."""
    coded = langs.dictionary_encode()
    if isinstance(coded, pa.ChunkedArray):
        coded = coded.combine_chunks()
    values = np.array([digest(x.encode()) for x in coded.dictionary.to_pylist()], np.uint64)
    return (values[coded.indices.to_numpy()] if len(values) else np.zeros(0, np.uint64)), coded.to_pylist()


def vocabulary(docs: DataFrame) -> DataFrame:
    """(lang, key, word, n): how often each word of each language occurs."""
    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values, langs = _lang_values(batch.column(0))
            names = np.array(langs, dtype=object)
            held, size = [], 0
            for words in words_of(batch.column(1), values):
                held.append(words)
                size += len(words.hashes)
                if size >= WORDS:
                    yield _distinct(held, names)
                    held, size = [], 0
            if held:
                yield _distinct(held, names)

    return docs.mapInArrow(count, "lang string, key long, word string, n long").groupBy("lang", "key", "word").agg(
        F.sum("n").alias("n"))


def _distinct(held: list[Words], langs: np.ndarray) -> pa.RecordBatch:
    hashes = np.concatenate([w.hashes for w in held])
    keys, at, n = np.unique(hashes, return_index=True, return_counts=True)
    ends = np.cumsum([len(w.hashes) for w in held])
    texts, docs = [None] * len(at), np.zeros(len(at), np.int64)
    order = np.argsort(at, kind="stable")
    for k, words in enumerate(held):
        lo = int(ends[k]) - len(words.hashes)
        mine = order[np.searchsorted(at[order], lo):np.searchsorted(at[order], ends[k])]
        own = at[mine] - lo
        docs[mine] = words.docs[own]
        data = words.data.tobytes()
        for i, a, size in zip(mine.tolist(), words.starts[own].tolist(), words.sizes[own].tolist(), strict=True):
            texts[i] = data[a:a + size]
    return pa.RecordBatch.from_arrays(
        [pa.array(langs[docs], pa.string()), pa.array(keys.view(np.int64)), pa.array(texts, pa.binary()).cast(pa.string()),
         pa.array(n.astype(np.int64))], ["lang", "key", "word", "n"])


def numbered(docs: DataFrame, words: Published, kind: str = "u4") -> DataFrame:
    """(lead, ids): the corpus as numbers of frequent words, 0 where no phrase goes on.

    ``ids`` are numbers of type ``kind``; the first ``lead`` ones repeat the end of the row before.
    """
    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = DigestArray(words)
        for batch in batches:
            values, _ = _lang_values(batch.column(0))
            lead, held, size, last = np.zeros(0, kind), [], 0, -1
            for found in words_of(batch.column(1), values):
                ids = known.numbers(found.hashes) + 1
                new = np.diff(found.pieces, prepend=last) != 0   # a 0 before each new piece
                last = int(found.pieces[-1])
                line = np.zeros(len(ids) + int(new.sum()), kind)
                line[np.arange(len(ids)) + np.cumsum(new)] = ids
                held.append(line)
                size += len(line)
                if size >= WORDS:
                    line = np.concatenate([lead, *held])
                    yield _line(len(lead), line)
                    lead, held, size = line[1 - LONGEST:], [], 0
            if held:
                yield _line(len(lead), np.concatenate([lead, *held]))

    return docs.mapInArrow(number, "lead int, ids binary")


def _line(lead: int, ids: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([lead], pa.int32()), pa.array([ids.tobytes()], pa.binary())], ["lead", "ids"])


def window_values(ids: list[np.ndarray]) -> np.ndarray:
    """A 64-bit value of each n-gram, given one array of ids per place."""
    out = np.zeros(len(ids[0]), np.uint64)
    for x in ids:
        out = mix((out ^ x.astype(np.uint64)) + _BASE)
    return out


def _place(values: np.ndarray) -> np.ndarray:
    """Where a value is in the bit set."""
    return (values >> np.uint64(64 - SET_BITS)).astype(np.int64)


def count_order(lines: DataFrame, words: Published, order: int, bits: int, shard_bits: int, least: int,
                maybe: np.ndarray | None, kind: str = "u4") -> DataFrame:
    """(lang, phrase, f, place) of the phrases of ``order`` words that occur ``least`` times."""
    layout = quotient.Layout(order, bits)
    shard_bits = min(shard_bits, layout.widths[0])
    shift = np.uint64(layout.widths[0] - shard_bits)
    shared = lines.sparkSession.sparkContext.broadcast(maybe)  # of a fixed size

    def cut(limbs: list[np.ndarray], counts: np.ndarray) -> Iterator[pa.RecordBatch]:
        shards = (limbs[0] >> shift).astype(np.int64) if shard_bits else np.zeros(len(counts), np.int64)
        edge = np.flatnonzero(np.diff(shards, prepend=-1))
        blobs = [quotient.encode([x[a:b] for x in limbs], counts[a:b], layout, shard_bits)
                 for a, b in zip(edge.tolist(), [*edge[1:].tolist(), len(shards)], strict=True)]
        yield pa.RecordBatch.from_arrays([pa.array(shards[edge].astype(np.int32)), pa.array(blobs, pa.binary())],
                                         ["shard", "filter"])

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for batch in batches:
            for lead, blob in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.frombuffer(blob.as_buffer(), kind)
                at = _windows(ids, lead, order, shared.value)
                if not len(at):
                    continue
                held.append(quotient.counted(quotient.pack([ids[at + k] for k in range(order)], layout)))
                size += len(held[-1][1])
                if size >= WORDS:
                    held = [quotient.merge(held)]
                    size = len(held[0][1])
                    if size >= WORDS // 2:
                        yield from cut(*held.pop())
                        size = 0
        if held:
            yield from cut(*quotient.merge(held))

    def merge(group: pa.Table) -> pa.Table:
        known = DigestArray(words)
        shard = group.column("shard")[0].as_py()
        limbs, counts = quotient.merge([quotient.decode(b, layout, shard_bits, shard)
                                        for b in group.column("filter").to_pylist()])
        often = counts >= least
        ids = quotient.unpack([x[often] for x in limbs], layout)
        place = _place(window_values(ids))
        phrases, langs = [], []
        for row in zip(*(x.tolist() for x in ids), strict=True):
            parts = [known.entry(k - 1) for k in row]
            phrases.append(b" ".join(p[0] for p in parts))
            langs.append(parts[0][1])
        return pa.table({"lang": pa.array(langs, pa.binary()).cast(pa.string()),
                         "phrase": pa.array(phrases, pa.binary()).cast(pa.string()),
                         "f": pa.array(counts[often].astype(np.int64)), "place": pa.array(place)})

    filters = lines.mapInArrow(count, "shard int, filter binary")
    return filters.groupBy("shard").applyInArrow(merge, "lang string, phrase string, f long, place long")


def _windows(ids: np.ndarray, lead: int, order: int, maybe: np.ndarray | None) -> np.ndarray:
    """Where the windows of ``order`` words begin that may be frequent."""
    n = len(ids) - order + 1
    if n <= 0:
        return np.zeros(0, np.int64)
    word = ids != 0
    good = word[:n].copy()
    for k in range(1, order):
        good &= word[k:k + n]
    good[:max(lead - order + 1, 0)] = False   # those that end in the lead were counted before
    at = np.flatnonzero(good)
    if maybe is not None and len(at):
        # both windows of one word less must be in the set; each is looked up once
        starts = np.union1d(at, at + 1)
        place = _place(window_values([ids[starts + k] for k in range(order - 1)]))
        held = np.zeros(len(ids) + 1, bool)
        held[starts] = (maybe[place >> 3] >> (place & 7).astype(np.uint8)) & 1
        at = at[held[at] & held[at + 1]]
    return at


def _bit_set(frequent: DataFrame) -> np.ndarray:
    """The bit set of ``place`` values: at most ``2 ** SET_BITS`` bits reach the driver."""
    at = F.col("place") + 1   # the functions count from 1
    rows = frequent.groupBy(F.bitmap_bucket_number(at).alias("bucket")).agg(
        F.bitmap_construct_agg(F.bitmap_bit_position(at)).alias("bits")).toLocalIterator()
    out = np.zeros(1 << (SET_BITS - 3), np.uint8)
    for row in rows:
        bits = np.frombuffer(row["bits"], np.uint8)
        lo = (row["bucket"] - 1) * len(bits)
        out[lo:lo + len(bits)] = bits
    return out


def frequencies(run: Scratch, docs: DataFrame, least: int, longest: int) -> tuple[list[DataFrame], DataFrame]:
    """Frequent phrases of each length from 1, as (lang, phrase, f); and n per lang."""
    all_words = run.stage_texts(vocabulary(docs), "vocabulary")
    totals = run.stage(all_words.groupBy("lang").agg(F.sum("n").alias("n")), "totals")
    often = run.stage(all_words.filter(F.col("n") >= least), "often")
    orders = [often.select("lang", F.col("word").alias("phrase"), F.col("n").alias("f"))]
    size = often.agg(F.count("*").alias("v"), F.sum("n").alias("n")).first()
    if not size["v"]:
        return orders, totals
    words = publish(often.select("key", F.col("word").alias("text"), F.col("lang").alias("payload")), "phrase-words")
    kind = "u4" if size["v"] < 1 << 32 else "u8"
    lines = run.stage_texts(numbered(docs, words, kind), "lines")
    bits = int(size["v"]).bit_length()
    shard_bits = max((int(size["n"]) // SHARD).bit_length(), LEAST_SHARD_BITS)
    maybe = None
    for order in range(2, longest + 1):
        found = run.stage_texts(count_order(lines, words, order, bits, shard_bits, least, maybe, kind), f"order{order}")
        orders.append(found.select("lang", "phrase", "f"))
        if order < longest:
            maybe = _bit_set(found)
    return orders, totals


def _parts(lo: Column, n: Column) -> Column:
    return F.concat_ws(" ", F.slice("words", lo, n))


def collocations(run: Scratch, docs: DataFrame, least: int = LEAST, longest: int = LONGEST, per_lang: int = PER_LANG,
                 percent: int = 100, text_col: str = "text", lang_col: str = "lang") -> DataFrame:
    """The best phrases of each language: lang, rank, phrase, a, l, r, n, score.

    Texts are lower-cased (A-Z), cut into pieces at ``.,;:!?`` and line ends, those into
    words at blanks and tabs.  Candidates are the phrases of 2 to ``longest`` words with
    ``a >= least`` occurrences within pieces; ``l`` and ``r`` are the occurrences of the
    two parts of the cut with the lowest score ``floor(1000 * a * n / (l * r))`` (the
    first such cut), ``n`` all words of the language.  Candidates inside a longer
    candidate with ``100 * f >= percent * a`` are left out.  Ranked by score, then a,
    both falling, then the phrase by its bytes; the first ``per_lang`` of each language.

    A null language is ``und``; a null or empty text has no words; rows that repeat count
    each.  An empty table gives no rows.  Other columns are not read.
    """
    texts = docs.select(F.coalesce(F.col(lang_col), F.lit("und")).alias("lang"),
                        F.coalesce(F.col(text_col), F.lit("")).alias("text"))
    orders, totals = frequencies(run, texts, least, longest)
    f = orders[0]
    for more in orders[1:]:
        f = f.unionByName(more)
    f = run.stage_texts(f, "frequencies")
    longer = f.filter(F.instr("phrase", " ") > 0).withColumn("words", F.split("phrase", " "))
    size = F.size("words")
    # a candidate inside a longer one: the largest count among those that hold it
    inner = F.flatten(F.transform(F.sequence(F.lit(2), size - 1), lambda n: F.transform(
        F.sequence(F.lit(1), size - n + 1), lambda at: _parts(at, n))))
    inside = longer.filter(size > 2).select("lang", F.explode(inner).alias("phrase"), "f").groupBy("lang", "phrase").agg(
        F.max("f").alias("around"))
    kept = longer.join(inside, ["lang", "phrase"], "left").filter(
        F.coalesce(F.lit(100) * F.col("around") < F.lit(percent) * F.col("f"), F.lit(True)))
    cuts = run.stage_texts(kept.select("lang", "phrase", F.col("f").alias("a"), F.explode(F.transform(
        F.sequence(F.lit(1), size - 1), lambda k: F.struct(k.alias("k"), _parts(F.lit(1), k).alias("one"), _parts(
            k + 1, size - k).alias("two")))).alias("cut")).select("lang", "phrase", "a", "cut.*"), "cuts")
    for part, name in (("one", "l"), ("two", "r")):
        asked = cuts.groupBy("lang", part).agg(F.count("*").alias("asked"))
        known = run.stage_texts(asked.join(f.select("lang", F.col("phrase").alias(part), F.col("f").alias(name)),
                                           ["lang", part]), f"parts-{name}")
        cuts = run.stage_texts(lookup(cuts, known, ["lang", part], "asked").drop(part), f"cuts-{name}")
    per = cuts.groupBy("lang").agg(F.count("*").alias("asked")).join(totals, "lang")
    cuts = lookup(cuts, run.stage(per, "per"), ["lang"], "asked")
    exact = {c: F.col(c).cast("decimal(38,0)") for c in "alrn"}
    scored = cuts.withColumns({f"_{c}": v for c, v in exact.items()}).withColumn(
        "score", F.expr("(_a * _n * 1000) div (_l * _r)"))
    best = scored.groupBy("lang", "phrase", "a", "n").agg(F.min(F.struct("score", "k", "l", "r")).alias("cut")).select(
        "lang", "phrase", "a", "cut.l", "cut.r", "n", "cut.score")
    order = [F.desc("score"), F.desc("a"), F.col("phrase")]
    # ranked in parts first, so that one task has to rank only SPREAD times as many as are kept
    part = F.pmod(F.xxhash64("phrase"), F.lit(SPREAD))
    first = best.withColumn("part", part).withColumn("rank", F.row_number().over(
        Window.partitionBy("lang", "part").orderBy(*order))).filter(F.col("rank") <= per_lang)
    return first.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order)).cast("long")).filter(
        F.col("rank") <= per_lang).select("lang", "rank", "phrase", "a", "l", "r", "n", "score")


def op12_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 2000 best phrases of each language of all documents."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    with scratch(spark) as run:
        return run.result(collocations(run, docs), "op12")


OP12_SQL = f"""
    WITH docs AS (
        SELECT row_number() OVER () AS doc, coalesce(lang, 'und') AS lang,
               translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS text
        FROM documents),
    pieces AS (
        SELECT row_number() OVER () AS piece, lang, regexp_extract_all(part, '[^ \\t]+') AS words
        FROM (SELECT lang, unnest(regexp_split_to_array(text, '[.,;:!?\\n\\x0B\\x0C\\r]')) AS part FROM docs)),
    placed AS (SELECT piece, lang, words, len(words) AS size, unnest(range(1, len(words) + 1)) AS k FROM pieces),
    totals AS (SELECT lang, count(*) AS n FROM placed GROUP BY lang),
    f AS (
        SELECT lang, m, array_to_string(words[k:k + m - 1], ' ') AS phrase, count(*) AS f
        FROM placed, range(1, {LONGEST + 1}) AS orders(m)
        WHERE k + m - 1 <= size
        GROUP BY lang, m, phrase HAVING count(*) >= {LEAST}),
    candidates AS (SELECT lang, m, phrase, f AS a, string_split(phrase, ' ') AS words FROM f WHERE m > 1),
    inner_parts AS (
        SELECT lang, array_to_string(words[k:k + j - 1], ' ') AS phrase, max(a) AS around
        FROM (SELECT lang, words, a, m, j, unnest(range(1, m - j + 2)) AS k
              FROM (SELECT *, unnest(range(2, m)) AS j FROM candidates WHERE m > 2))
        GROUP BY ALL),
    kept AS (
        SELECT c.* FROM candidates c LEFT JOIN inner_parts i ON c.lang = i.lang AND c.phrase = i.phrase
        WHERE around IS NULL OR around * 100 < a * 100),
    cuts AS (
        SELECT c.lang, c.phrase, a, k, one.f AS l, two.f AS r, n,
               CAST((CAST(a AS HUGEINT) * n * 1000) // (CAST(one.f AS HUGEINT) * two.f) AS BIGINT) AS score
        FROM (SELECT *, unnest(range(1, m)) AS k FROM kept) c
        JOIN f one ON one.lang = c.lang AND one.phrase = array_to_string(words[:k], ' ')
        JOIN f two ON two.lang = c.lang AND two.phrase = array_to_string(words[k + 1:], ' ')
        JOIN totals t ON t.lang = c.lang),
    best AS (SELECT * FROM cuts QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
    ranked AS (SELECT *, row_number() OVER (PARTITION BY lang ORDER BY score DESC, a DESC, encode(phrase)) AS rank FROM best)
    SELECT lang, rank, phrase, a, l, r, n, score FROM ranked WHERE rank <= {PER_LANG}"""
