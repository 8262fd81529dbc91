"""Collocations: phrases whose words occur together more often than apart, mined after Toivonen.

1. Sample. A share of the texts proposes words and phrases.
2. Full pass. Every word is counted, and every phrase whose two parts without the last and without the first word are proposed:
   that is the proposals and their negative border, exactly, over all texts.
3. Expansion. Frequent words and phrases that were not proposed are failures of the border: longer ones with them were not
   counted yet. They join the proposals, and a further pass counts what became countable, and nothing twice. Without failures
   the result is closed; phrases of three words need two expansions at most.

Tasks count with numbers of their own for words and phrases, so counts are of the words themselves and not of hashes. Only the
question whether a phrase is proposed is answered from a bitmap of hashes. It is the same for every occurrence of a phrase, so
a wrong bit makes a task count more than needed, never less or twice. The bitmap has sixteen bits for each member up to
``_MOST_BITS``; a fuller one saves less work and changes no result.
"""

from __future__ import annotations

import zlib
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from rolemart.llm.common import landed, mixed, text_of, tidy, word_hashes
from rolemart.llm.exchange import expected_units

_MOST_BITS = 1 << 31
_PARTS = 64
#: Upper case to lower case, tabs to blanks, and the marks that end a piece to one of them, which is in no word.
_FOLD = bytes(c + 32 if 65 <= c <= 90 else 32 if c == 9 else 46 if c in b".,;:!?\x0a\x0b\x0c\x0d" else c for c in range(256))
_END = b"."
#: Between packed phrases; a line end is in no word.
_SPLIT = b"\n"
_SENT = "part int, lang string, size int, phrases binary, times binary"

#: Language, words of a phrase, phrases and how often each occurs.
Group = tuple[str, int, list[bytes], np.ndarray]


class Bitmap:
    def __init__(self, bits: np.ndarray | None = None) -> None:
        self.bits = bits

    def has(self, hashes: np.ndarray) -> np.ndarray:
        if self.bits is None:
            return np.zeros(len(hashes), bool)
        slot = hashes & np.uint64(len(self.bits) * 64 - 1)
        return (self.bits[(slot >> np.uint64(6)).astype(np.int64)] >> (slot & np.uint64(63)) & np.uint64(1)).astype(bool)


def _longer(first: np.ndarray, last: np.ndarray) -> np.ndarray:
    """Hashes of phrases from those of their parts without the last and without the first word."""
    return mixed(mixed(first) + last)


def phrase_hash(lang: str, words: list[bytes]) -> int:
    level = word_hashes([lang.encode() + b"\0" + w for w in words])
    while len(level) > 1:
        level = _longer(level[:-1], level[1:])
    return int(level[0])


class _Numbers(dict):
    """Words to numbers of the task; the mark between pieces is 0 in every language."""

    def __init__(self, lang: str, names: list[bytes], langs: list[str]) -> None:
        self[_END] = 0
        self.lang, self.names, self.langs = lang, names, langs

    def __missing__(self, word: bytes) -> int:
        self[word] = n = len(self.names)
        self.names.append(word)
        self.langs.append(self.lang)
        return n


class Counter:
    """Counts of one task. ``proposed`` and ``before``: the bitmaps of this pass and of the one before, None for the first."""

    def __init__(self, max_words: int, proposed: Bitmap, before: Bitmap | None, propose_all: bool = False) -> None:
        self.max_words, self.proposed, self.before, self.propose_all = max_words, proposed, before, propose_all
        self._clear([], "")

    def _clear(self, carried: list[bytes], lang: str) -> None:
        self.names, self.langs = [_END], [""]
        self.numbers: dict[str, _Numbers] = {}
        self.held = [np.zeros(1, np.int64)]
        self.size, self.carried = 1, 1
        if carried:
            self._add(carried, lang)
            self.carried = self.size

    def _add(self, words: list[bytes], lang: str) -> None:
        if lang not in self.numbers:
            self.numbers[lang] = _Numbers(lang, self.names, self.langs)
        self.held.append(np.fromiter(map(self.numbers[lang].__getitem__, words), np.int64, len(words)))
        self.size += len(words)

    def text(self, data: bytes, lang: str, most: int, slice_bytes: int = 1 << 22) -> Iterator[list[Group]]:
        """Count a text; yields groups whenever ``most`` words have come together, also within a text."""
        at = 0
        while at < len(data):
            end = at + slice_bytes
            if end < len(data):  # behind a blank or the end of a piece, wherever the next one is
                while end < len(data) and _FOLD[data[end - 1]] not in (32, 46):
                    end += 1
            self._add(data[at:end].translate(_FOLD).replace(b".", b" . ").split(), lang)
            at = end
            if self.size >= most:
                last = [self.names[i] for i in np.concatenate(self.held)[-(self.max_words - 1) :]] if self.max_words > 1 else []
                yield self.rows()
                self._clear(last, lang)
        self.held.append(np.zeros(1, np.int64))
        self.size += 1

    def rows(self) -> list[Group]:
        """(lang, size, phrases, times) of all that this pass counts, and (lang, 0, [b""], words) in the first pass."""
        ids = np.concatenate(self.held)
        names, langs = np.array(self.names, object), np.array(self.langs, object)
        out: list[Group] = []
        hashes = word_hashes([g.encode() + b"\0" + w for g, w in zip(self.langs, self.names, strict=True)])
        is_word = np.arange(len(names)) > 0

        def tell(size: int, of: np.ndarray, phrases: list[bytes], times: np.ndarray) -> None:
            """By language; ``of`` has a word of each phrase."""
            if len(self.numbers) == 1:
                out.append((next(iter(self.numbers)), size, phrases, times))
                return
            own, phrases = langs[of], np.array(phrases, object)
            for lang in self.numbers:
                here = np.flatnonzero(own == lang)
                out.append((lang, size, phrases[here].tolist(), times[here]))

        if self.before is None and self.numbers:
            times = np.bincount(ids[self.carried :], minlength=len(names))
            found = np.flatnonzero((times > 0) & is_word)
            tell(1, found, names[found].tolist(), times[found])
            out += [(lang, 0, [b""], n.sum(keepdims=True)) for lang, _, _, n in list(out)]

        def within(bitmap: Bitmap | None, eligible: np.ndarray) -> np.ndarray:
            if bitmap is None:
                return np.zeros(len(eligible), bool)
            return eligible if self.propose_all else eligible & bitmap.has(hashes)

        now, old = within(self.proposed, is_word), within(self.before, is_word)
        members = ids  # the number of the phrase that starts at a place, -1 for none
        for size in range(2, self.max_words + 1):
            first, last = members[:-1], members[1:]
            places = np.flatnonzero((first >= 0) & (last >= 0))
            places = places[now[first[places]] & now[last[places]]]
            if not len(places):
                break
            codes, which = np.unique(first[places] << 32 | last[places], return_inverse=True)
            begins = np.empty(len(codes), np.int64)
            begins[which] = places
            a, b = codes >> 32, codes & 0xFFFFFFFF
            times = np.bincount(which[places + size > self.carried], minlength=len(codes))
            earlier = old[a] & old[b] if self.before is not None else np.zeros(len(codes), bool)
            wanted = np.flatnonzero((times > 0) & ~earlier)
            starts = begins[wanted]
            tell(size, ids[starts], list(map(b" ".join, zip(*(names[ids[starts + k]].tolist() for k in range(size)), strict=True))), times[wanted])
            if size < self.max_words:
                hashes = _longer(hashes[a], hashes[b])
                now, old = within(self.proposed, np.ones(len(codes), bool)), within(self.before, earlier)
                members = np.full(len(first), -1, np.int64)
                members[places] = which
        return [g for g in out if len(g[2])]


def _batch(rows: list[tuple], kinds: tuple[pa.DataType, ...], names: list[str]) -> pa.RecordBatch:
    columns = list(zip(*rows, strict=True)) or [()] * len(kinds)
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds, strict=True)], names=names)


def _counted(docs: DataFrame, max_words: int, proposed: Bitmap, before: Bitmap | None, least: int, propose_all: bool = False, most: int = 1_500_000) -> DataFrame:
    """(lang, size, phrase, f) of what a pass counts with f >= least, and of size 0 the words of each language.

    Tasks send the phrases of a part of the hash space packed in one row. The parts follow the size of the texts.
    """
    parts = max(16, expected_units(docs, 2) // 2_000_000)
    share = docs.sparkSession.sparkContext.broadcast((proposed, before))  # at most 2 * _MOST_BITS bits and their forerunners
    sent = (pa.int32(), pa.string(), pa.int32(), pa.binary(), pa.binary())
    told = (pa.string(), pa.int32(), pa.string(), pa.int64())

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counter = Counter(max_words, *share.value, propose_all)

        def packed(groups: list[Group]) -> Iterator[pa.RecordBatch]:
            for lang, size, phrases, times in groups:
                part = np.fromiter(map(zlib.crc32, phrases), np.int64, len(phrases)) % parts
                order = np.argsort(part, kind="stable")
                edges = np.searchsorted(part[order], np.arange(parts + 1))
                held, times = np.array(phrases, object)[order].tolist(), times[order].astype("<i8")
                full = np.flatnonzero(edges[1:] > edges[:-1]).tolist()
                rows = [(i, lang, size, _SPLIT.join(held[edges[i] : edges[i + 1]]), times[edges[i] : edges[i + 1]].tobytes()) for i in full]
                yield _batch(rows, sent, ["part", "lang", "size", "phrases", "times"])

        for batch in batches:
            for lang, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                for groups in counter.text(text.as_buffer().to_pybytes(), lang, most):
                    yield from packed(groups)
            if counter.size >= most // 2:
                yield from packed(counter.rows())
                counter._clear([], "")
        yield from packed(counter.rows())

    def merge(key: tuple, batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: dict[tuple[str, int], dict[bytes, int]] = defaultdict(lambda: defaultdict(int))
        for batch in batches:
            for lang, size, phrases, times in zip(*(batch.column(c).to_pylist() for c in ("lang", "size", "phrases", "times")), strict=True):
                own = total[lang, size]
                for phrase, n in zip(phrases.split(_SPLIT), np.frombuffer(times, "<i8").tolist(), strict=True):
                    own[phrase] += n
        for (lang, size), own in total.items():
            found = [(lang, size, p.decode(), n) for p, n in own.items() if n >= least or not size]
            for at in range(0, len(found), 100_000):
                yield _batch(found[at : at + 100_000], told, ["lang", "size", "phrase", "f"])

    read = docs.select(F.coalesce(docs["lang"].cast("string"), F.lit("und")).alias("lang"), text_of(docs).alias("text"))
    return read.mapInArrow(tidy(count), _SENT).groupBy("part").applyInArrow(merge, "lang string, size int, phrase string, f long")


def _bitmap(members: DataFrame) -> Bitmap:
    """Bits of the phrases' hashes; its size follows their number."""
    n = members.count()
    if not n:
        return Bitmap()
    slots = min(_MOST_BITS, max(1 << 16, 1 << (16 * n - 1).bit_length()))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [phrase_hash(g, p.encode().split(b" ")) & (slots - 1) for g, p in zip(*(c.to_pylist() for c in batch.columns), strict=True)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], names=["slot"])

    words = (
        members.select("lang", "phrase").mapInArrow(place, "slot long").groupBy(F.floor(F.col("slot") / 64).cast("int").alias("at"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("long"), F.pmod("slot", F.lit(64)).cast("int"))).alias("bits"))
    )
    found = words.toArrow()  # at most slots / 64 rows of twelve bytes
    out = np.zeros(slots // 64, np.uint64)
    out[found.column("at").to_numpy()] = found.column("bits").to_numpy().view(np.uint64)
    return Bitmap(out)


def _both(a: DataFrame | None, b: DataFrame) -> DataFrame:
    return b if a is None else a.unionByName(b)


def frequent_phrases(docs: DataFrame, min_count: int = 10, max_words: int = 3, sample_percent: int = 5) -> tuple[DataFrame, DataFrame]:
    """Exact counts: (lang, size, phrase, f) of all phrases of up to ``max_words`` words with f >= min_count, and (lang, n).

    The sample is taken by a hash of the text. It decides how much the first pass counts and how much is left to the
    expansions, and nothing else: with any share, zero too, the result is the same.
    """
    share = F.pmod(F.xxhash64(text_of(docs)), F.lit(100)) < sample_percent
    proposed = Bitmap()
    if sample_percent:
        likely = max(2, min_count * sample_percent // 200)
        proposed = _bitmap(landed(_counted(docs.where(share), max_words - 1, proposed, None, likely, True).where("size > 0").select("lang", "phrase"), "proposed"))
    before, found, totals = None, None, None
    while True:
        counted = landed(_counted(docs, max_words, proposed, before, min_count), "counted")
        if totals is None:
            totals = counted.where("size = 0").groupBy("lang").agg(F.sum("f").alias("n"))
        found = _both(found, counted.where("size > 0"))
        failures = landed(_failures(counted.where((F.col("size") > 0) & (F.col("size") < max_words)), proposed), "failures")
        if failures.isEmpty():
            return found, totals
        grown = _bitmap(found.where(F.col("size") < max_words).select("lang", "phrase"))
        before, proposed = proposed, Joined(proposed, grown)


class Joined(Bitmap):
    """Members of two bitmaps. The sizes differ, so that both are kept; an earlier pair gives way to the larger one of it."""

    def __init__(self, old: Bitmap, new: Bitmap) -> None:
        super().__init__(new.bits)
        self.old = old

    def has(self, hashes: np.ndarray) -> np.ndarray:
        return super().has(hashes) | self.old.has(hashes)


def _failures(frequent: DataFrame, proposed: Bitmap) -> DataFrame:
    """The frequent phrases that were in the border and not proposed."""
    share = frequent.sparkSession.sparkContext.broadcast(proposed)

    def check(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows = list(zip(*(c.to_pylist() for c in batch.columns), strict=True))
            hashes = np.array([phrase_hash(g, p.encode().split(b" ")) for g, p in rows], np.uint64)
            yield batch.filter(pa.array(~share.value.has(hashes)))

    return frequent.select("lang", "phrase").mapInArrow(check, "lang string, phrase string")


def _parts(phrase: Column, size: Column, shortest: int) -> Column:
    """All shorter runs of at least ``shortest`` of a phrase's words."""
    words = F.split(phrase, " ")
    runs = F.transform(F.sequence(F.lit(shortest), size - 1), lambda m: F.transform(F.sequence(F.lit(1), size - m + 1), lambda at: F.array_join(F.slice(words, at, m), " ")))
    return F.when(size > shortest, F.array_distinct(F.flatten(runs))).otherwise(F.array().cast("array<string>"))


def collocations(docs: DataFrame, min_count: int = 10, max_words: int = 3, covered_percent: int = 50, top: int = 2000, sample_percent: int = 5) -> DataFrame:
    """Each language's first ``top`` phrases: lang, rank, phrase, a, l, r, n, score.

    Words are separated by blanks and tabs, A-Z in lower case; the marks ``.,;:!?`` and line ends separate pieces, and phrases
    lie within a piece. n: words of the language; a: occurrences of a phrase of two to ``max_words`` words, at least
    ``min_count``; l, r: those of its parts at the cut with the lowest score floor(1000000 * a * a / (l * r)), the first of
    equal ones. A phrase within a longer one that has at least ``covered_percent`` of its occurrences is dropped. Order: score
    and a descending, phrase by its bytes. All arithmetic is exact in 38 digits.

    NULL and empty texts have no words; a NULL language is ``und``; repeated rows count again; an empty table gives no rows;
    further columns are ignored, doc_id too. Texts of any length are counted whole, in slices that lose nothing at their ends.
    """
    found, totals = frequent_phrases(docs, min_count, max_words, sample_percent)
    known = landed(found.select("lang", "size", "phrase", "f"), "phrases")
    candidates = known.where("size > 1")
    longest = (
        candidates.where("size > 2").select("lang", F.col("f").alias("longer"), F.explode(_parts(F.col("phrase"), F.col("size"), 2)).alias("phrase"))
        .groupBy("lang", "phrase").agg(F.max("longer").alias("longer"))
    )
    free = candidates.join(longest, ["lang", "phrase"], "left").where(F.col("longer").isNull() | (F.col("longer") * 100 < F.col("f") * covered_percent)).drop("longer")
    cut = free.select("lang", "phrase", F.col("f").alias("a"), "size", F.explode(F.sequence(F.lit(1), F.col("size") - 1)).alias("k"))
    words = F.split("phrase", " ")
    cut = cut.withColumn("first", F.array_join(F.slice(words, F.lit(1), F.col("k")), " ")).withColumn("last", F.array_join(F.slice(words, F.col("k") + 1, F.col("size")), " "))
    left, right = (known.select("lang", F.col("phrase").alias(c), F.col("f").alias(n)) for c, n in (("first", "l"), ("last", "r")))
    wide = cut.join(left, ["lang", "first"]).join(right, ["lang", "last"])
    score = F.expr("(CAST(1000000 AS DECIMAL(38,0)) * a * a) DIV (CAST(l AS DECIMAL(38,0)) * r)").cast("long")
    scored = (
        wide.withColumn("score", score).groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("low"))
        .select("lang", "phrase", "a", "low.l", "low.r", "low.score")
    )
    order = (F.col("score").desc(), F.col("a").desc(), F.col("phrase"))
    # no task ranks all phrases of a language: the first of each part, then the first of these
    part = F.pmod(F.xxhash64("phrase"), F.lit(_PARTS))
    best = scored.withColumn("part", part).withColumn("rank", F.row_number().over(Window.partitionBy("lang", "part").orderBy(*order))).where(F.col("rank") <= top)
    ranked = best.withColumn("rank", F.row_number().over(Window.partitionBy("lang").orderBy(*order))).where(F.col("rank") <= top)
    return ranked.join(totals, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")
