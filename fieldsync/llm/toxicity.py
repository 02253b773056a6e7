"""Toxicity of texts from a learned lexicon, found through misspellings and weighed by context.

The lexicon holds stems (beginnings of words) that labelled toxic documents share and clean ones don't. It
is a trie. A word of a text is a Levenshtein automaton: its states are sets of (place in the word, edits so
far), and walking the trie with them finds every stem that the word begins with, up to a misspelling. The
evidence of a stem, and of its misspellings, is learned apart, so that a misspelling which is a common word
counts for nothing.

A hit is judged in its window of words: inside quotation marks or after words that report speech it is
quotation and counts little, beside a direct address it counts more. What a stem tells depends on how often
the text holds it, so counted: some clean texts have it once by chance. A document's evidence is the sum
over its stems; a logistic curve fitted on the labelled rows makes it a score.

What is learned comes from a bounded sample of labelled rows (`TOXIC_ROWS`, `CLEAN_ROWS`), chosen by a hash
of the id; every document is scored, over its whole text. Null and empty texts have no hits and get the
score of no evidence. Rows are independent, repeated ones get equal scores. Labels other than 0 and 1, or of
unknown documents, are not used; of contradicting labels the toxic one holds. Without both kinds of label
nothing is learned and each score is the share of toxic labels (0 if there are none).
"""

from __future__ import annotations

import math
import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from fieldsync.llm.batches import each_text, give_back, ship_code, texts_of
from fieldsync.llm.bpe import Memory
from fieldsync.sources.staging import stage

#: Labelled rows learned from at most (about): the bound of the sample.
TOXIC_ROWS, CLEAN_ROWS = 4_000, 8_000
#: Lengths of stems; stems kept at most, those with most evidence; length from which one edit is allowed.
STEM, STEMS, EDITED = (3, 12), 400, 5
#: Letters from which a word tells documents apart.
DISTINCT = 7
#: Toxic documents of the sample that must hold a stem.
SUPPORT = 3
#: Counted hits from which a text holds a stem once, twice, or more often.
LEVELS = (0.75, 1.5, 2.5)
#: What a misspelling tells of what the stem does, if the sample has none.
MISSPELT = 0.8
#: Words on each side of a hit that are its context; what quotation and address do to it.
CONTEXT, QUOTED, ADDRESSED = 6, 0.25, 1.25
#: Score from which a document is taken to be toxic.
THRESHOLD = 0.7

WORD = re.compile(r"[^\W_]+")
#: Opening marks with their closing ones. Fixed values.
MARKS = {'"': '"', "“": "”", "«": "»", "„": "“"}
#: Words that report what others say, and that address a reader. Fixed values.
REPORTING = frozenset("said says wrote writes called quoted quote reported term word phrase disait écrit sagte schrieb dijo escribió".split())
ADDRESSING = frozenset("you your youre tu vous toi du ihr euch usted ustedes vosotros".split())


def matching(word: str, trie: dict, edits: int) -> list[tuple[str, int]]:
    """Stems that `word` begins with at up to `edits` edits, with the fewest edits each: the word's automaton run along the trie."""
    found: dict[str, int] = {}
    start = {(i, i) for i in range(edits + 1)}  # i letters of the word left out
    walk = [(trie, {(p, e) for p, e in start if p <= len(word)})]
    while walk:
        node, states = walk.pop()
        if (stem := node.get("")) is not None:
            allowed = edits if len(stem) >= EDITED else 0
            if (best := min(e for _, e in states)) <= allowed:
                found[stem] = min(best, found.get(stem, best))
        for letter, below in node.items():
            if not letter:
                continue
            after = set()
            for p, e in states:
                if p < len(word) and word[p] == letter:
                    after.add((p + 1, e))
                if e < edits:
                    after.add((p, e + 1))  # the stem's letter is missing from the word
                    if p < len(word):
                        after.add((p + 1, e + 1))  # it is another one there
            grown = True
            while grown:  # letters of the word that the stem doesn't have
                more = {(p + 1, e + 1) for p, e in after if e < edits and p < len(word)} - after
                after |= more
                grown = bool(more)
            if after:
                walk.append((below, after))
    return sorted(found.items())


def trie_of(stems) -> dict:
    trie: dict = {}
    for stem in stems:
        node = trie
        for letter in stem:
            node = node.setdefault(letter, {})
        node[""] = stem
    return trie


def openings(stems) -> set[tuple[str, ...]]:
    """How words at one edit from a stem may begin, with a wildcard: words that begin otherwise need no automaton."""
    out = set()
    for stem in stems:
        a = (stem + "   ")[:4]
        if len(stem) < EDITED:
            out |= {("", a[1], a[2]), (a[0], "", a[2]), (a[0], a[1], "")}
            continue
        for b in (a[:3], a[1:4], a[0] + a[2:4], a[:2] + a[3], a[0] + "*" + a[1], "*" + a[:2], a[:2] + "*"):
            for i in range(3):
                masked = [*b]
                masked[i] = ""
                if "*" not in masked:
                    out.add(tuple(masked))
    return out


@dataclass
class Lexicon:
    """Stems with the evidence of their exact and misspelled hits, and the curve that makes evidence a score."""

    weights: dict[tuple[str, int, int], float] = field(default_factory=dict)
    slope: float = 0.0
    offset: float = -50.0

    def __post_init__(self) -> None:
        stems = {s for s, *_ in self.weights}
        self.trie, self.begins = trie_of(stems), openings(stems)
        self.memory = Memory(self.looked_up)

    def __reduce__(self):
        return Lexicon, (self.weights, self.slope, self.offset)

    def looked_up(self, word: str) -> tuple[tuple[str, int], ...]:
        a = (word + "   ")[:3]
        begins = self.begins
        if ("", a[1], a[2]) in begins or (a[0], "", a[2]) in begins or (a[0], a[1], "") in begins:
            return tuple(matching(word, self.trie, 1))
        return ()

    def hits(self, text: str) -> list[tuple[str, int, float]]:
        """Stem, edits and context factor of each hit."""
        lowered = text.lower()
        memory = self.memory
        if not any([memory[w] for w in set(WORD.findall(lowered))]):
            return []
        words = [(m.group(), m.start()) for m in WORD.finditer(lowered)]
        quoted = quotations(lowered)
        out = []
        for i, (word, at) in enumerate(words):
            found = memory[word]
            if found:
                near = {w for w, _ in words[max(0, i - CONTEXT) : i + CONTEXT + 1]}
                factor = QUOTED if quoted[at] or near & REPORTING else ADDRESSED if near & ADDRESSING else 1.0
                out += [(stem, edits, factor) for stem, edits in found]
        return out

    def levels(self, text: str) -> dict[tuple[str, int], int]:
        """How often the text holds each stem, exactly and misspelled."""
        counted: dict[tuple[str, int], float] = {}
        for stem, edits, factor in self.hits(text):
            counted[stem, edits] = counted.get((stem, edits), 0.0) + factor
        return {k: level for k, n in counted.items() if (level := sum(n >= x for x in LEVELS))}

    def evidence(self, text: str) -> tuple[float, list[str]]:
        best: dict[str, float] = {}
        for (stem, edits), level in self.levels(text).items():
            best[stem] = max(best.get(stem, 0.0), self.weights.get((stem, edits, level), 0.0))
        return sum(best[s] for s in sorted(best)), [s for s in sorted(best) if best[s] > 0]

    def score(self, evidence: float) -> float:
        return 1 / (1 + math.exp(-max(-50.0, min(50.0, self.slope * evidence + self.offset))))


def quotations(text: str) -> np.ndarray:
    """Which characters stand in quotation marks that close within the same line."""
    mask = np.zeros(len(text) + 1, bool)
    i = 0
    marks = re.compile("[" + "".join(MARKS) + "]")
    while m := marks.search(text, i):
        line = text.find("\n", m.end())
        end = text.find(MARKS[m.group()], m.end(), line if line >= 0 else len(text))
        i = m.end()
        if end >= 0:
            mask[m.end() : end] = True
            i = end + 1
    return mask


def held_out(doc_id: Column) -> Column:
    """Rows whose labels may not be learned."""
    return F.coalesce(F.crc32(doc_id.cast("string")) % 3 == 1, F.lit(False))


def sampled(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """text, toxic and fold of a bounded sample of the labelled rows that may be learned."""
    known = labels.where(F.col("toxic").isin(0, 1) & F.col("doc_id").isNotNull()).where(~held_out(F.col("doc_id")))
    known = known.groupBy("doc_id").agg(F.max("toxic").alias("toxic"))
    counts = {r["toxic"]: r["count"] for r in known.groupBy("toxic").count().collect()}
    place = F.pmod(F.xxhash64("doc_id"), F.lit(1 << 30)) / float(1 << 30)
    share = F.when(F.col("toxic") == 1, TOXIC_ROWS / max(1, counts.get(1, 0))).otherwise(CLEAN_ROWS / max(1, counts.get(0, 0)))
    # about TOXIC_ROWS + CLEAN_ROWS short rows, whatever the size of the tables
    some = known.where(place < share).limit(2 * (TOXIC_ROWS + CLEAN_ROWS))
    rows = docs.select("doc_id", "text").join(F.broadcast(some), "doc_id")
    # of copies, and of most near copies, one: those that share the least and the greatest hash of their long words
    words = F.filter(F.split(F.lower(F.coalesce("text", F.lit(""))), r"[^\p{L}]+"), lambda w: F.length(w) >= DISTINCT)
    rows = rows.withColumn("hashes", F.transform(words, lambda w: F.xxhash64(w)))
    rows = rows.withColumn("same", F.when(F.size("hashes") > 0, F.xxhash64(F.array_min("hashes"), F.array_max("hashes"))).otherwise(F.xxhash64("text")))
    first = rows.groupBy("same", "toxic").agg(F.min_by("text", "doc_id").alias("text"), F.min("doc_id").alias("doc_id"))
    return first.select("text", "toxic", F.pmod(F.hash("doc_id"), F.lit(2)).alias("fold"))


def stems_held(text: str) -> Counter:
    """How often a text has words that begin with each stem."""
    held: Counter = Counter()
    for word, n in Counter(WORD.findall(text.lower())).items():
        for k in range(STEM[0], min(len(word), STEM[1]) + 1):
            held[word[:k]] += n
    return held


def stem_counts(rows: DataFrame) -> DataFrame:
    """Of each beginning of a word: toxic documents that hold it, by fold, and twice or more often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = [Counter() for _ in range(3)]
        for batch in batches:
            for text, f in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                held = stems_held(text)
                counts[f].update(held.keys())
                counts[2].update(s for s, n in held.items() if n > 1)
        stems = [*(counts[0].keys() | counts[1].keys())]
        yield pa.RecordBatch.from_arrays([pa.array(stems, pa.string()), *(pa.array([c[s] for s in stems], pa.int64()) for c in counts)], names=["stem", "t0", "t1", "twice"])

    counted = rows.where("toxic = 1").select("text", "fold").mapInArrow(count, "stem string, t0 long, t1 long, twice long")
    return counted.groupBy("stem").agg(*(F.sum(c).alias(c) for c in ("t0", "t1", "twice")))


def chosen(stems: list[tuple[str, int, int, int, int]], toxic: int, clean: int) -> list[str]:
    """Stems that tell the labels apart by more than chance among so many would; of nested ones the one that does so best.

    Each comes with the toxic documents that hold it, those that hold it twice or more often, and the same of the clean ones.
    """

    def told(t: int, c: int) -> float:
        """Likelihood ratio of the counts, 0 if toxic documents don't have it twice as often as clean ones."""
        if t * clean <= 2 * c * toxic:
            return 0.0
        share = (t + c) / (toxic + clean)
        cells = ((t, toxic * share), (c, clean * share), (toxic - t, toxic * (1 - share)), (clean - c, clean * (1 - share)))
        return 2 * sum(n * math.log(n / expected) for n, expected in cells if n)

    signs = sorted(((value, len(s), s) for s, t, t2, c, c2 in stems if (value := max(told(t, c), told(t2, c2)))), reverse=True)
    needed = 2 * math.log(max(2, len(signs))) + 4
    kept: list[str] = []
    for value, _, s in signs:
        if value < needed or len(kept) == STEMS:
            break
        if not any(s.startswith(k) or k.startswith(s) for k in kept):
            kept.append(s)
    return sorted(kept)


def learned(docs: DataFrame, labels: DataFrame) -> Lexicon:
    """The lexicon of a bounded sample of labelled rows."""
    ship_code(docs.sparkSession)
    rows = stage(sampled(docs, labels), "toxicity-sample")
    sizes = {r["toxic"]: r["count"] for r in rows.groupBy("toxic").count().collect()}
    toxic, clean = sizes.get(1, 0), sizes.get(0, 0)
    if not toxic or not clean:
        return Lexicon({}, 0.0, 50.0 if toxic else -50.0)
    common = stem_counts(rows).where((F.col("t0") > 0) & (F.col("t1") > 0) & (F.col("t0") + F.col("t1") >= SUPPORT))
    found = {r["stem"]: (r["t0"] + r["t1"], r["twice"]) for r in common.collect()}  # at most the stems of the bounded sample
    counts = counted_clean(rows, set(found))
    stems = chosen([(s, *t, *counts.get(s, (0, 0))) for s, t in found.items()], toxic, clean)
    blank = Lexicon({(s, e, 1): 1.0 for s in stems for e in (0, 1)}, 1.0, 0.0)
    seen = {(r["stem"], r["edits"], r["level"]): (r["toxic"], r["clean"]) for r in hit_counts(rows, blank).collect()}
    weights = {}
    for s in stems:
        exact = edited = 0.0
        for level in range(1, len(LEVELS) + 1):  # more of it never tells less
            weights[s, 0, level] = exact = max(exact, told_by(*seen.get((s, 0, level), (0, 0)), toxic, clean))
            if len(s) >= EDITED:
                t, c = seen.get((s, 1, level), (0, 0))
                weights[s, 1, level] = edited = max(edited, min(exact, told_by(t, c, toxic, clean)) if t + c else MISSPELT * exact)
                if c and not t:  # its misspellings are other words
                    weights[s, 1, level] = edited = 0.0
    lexicon = Lexicon(weights)
    points = [(r["evidence"], r["toxic"]) for r in evidences(rows, lexicon).collect()]  # the bounded sample
    return Lexicon(weights, *curve(np.array([p[0] for p in points]), np.array([p[1] for p in points], float)))


def told_by(t: int, c: int, toxic: int, clean: int) -> float:
    return max(0.0, math.log((t + 0.5) / (toxic + 1)) - math.log((c + 0.5) / (clean + 1)))


def counted_clean(rows: DataFrame, wanted: set[str]) -> dict[str, tuple[int, int]]:
    """Clean documents of the sample that hold each of some stems, and twice or more often."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text in texts_of(batch.column(0)):
                held = {s: n for s, n in stems_held(text).items() if s in wanted}
                counts[0].update(held.keys())
                counts[1].update(s for s, n in held.items() if n > 1)
        yield pa.RecordBatch.from_arrays([pa.array([*counts[0]], pa.string()), *(pa.array([c[s] for s in counts[0]], pa.int64()) for c in counts)], names=["stem", "n", "twice"])

    counted = rows.where("toxic = 0").select("text").mapInArrow(count, "stem string, n long, twice long").groupBy("stem").agg(F.sum("n").alias("n"), F.sum("twice").alias("twice"))
    return {r["stem"]: (r["n"], r["twice"]) for r in counted.collect()}


def hit_counts(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    """Documents that hold a stem, by stem, edits, how often, and label."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = (Counter(), Counter())
        for batch in batches:
            for text, t in zip(texts_of(batch.column(0)), batch.column(1).to_pylist(), strict=True):
                counts[t].update((s, e, level) for (s, e), level in lexicon.levels(text).items())
        keys = [*(counts[0].keys() | counts[1].keys())]
        yield pa.RecordBatch.from_arrays(
            [pa.array([k[0] for k in keys], pa.string()), *(pa.array([k[i] for k in keys], pa.int32()) for i in (1, 2)), *(pa.array([counts[t][k] for k in keys], pa.int64()) for t in (1, 0))],
            names=["stem", "edits", "level", "toxic", "clean"],
        )

    counted = rows.select("text", "toxic").mapInArrow(count, "stem string, edits int, level int, toxic long, clean long")
    return counted.groupBy("stem", "edits", "level").agg(F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean"))


def evidences(rows: DataFrame, lexicon: Lexicon) -> DataFrame:
    @F.arrow_udf("double")
    def evidence(texts: pa.Array) -> pa.Array:
        return pa.array([lexicon.evidence(t)[0] for t in texts_of(texts)], pa.float64())

    return rows.select(evidence("text").alias("evidence"), "toxic")


def curve(evidence: np.ndarray, toxic: np.ndarray, penalty: float = 1.0) -> tuple[float, float]:
    """Slope and offset of a logistic curve, by Newton's method with a penalty on the slope."""
    x, weight = np.stack([evidence, np.ones(len(evidence))], axis=1), penalty * np.array([1, 0.01])

    def loss(at: np.ndarray) -> float:
        z = x @ at
        return float((np.logaddexp(0, z) - toxic * z).sum() + (weight * at * at).sum() / 2)

    at = np.zeros(2)
    for _ in range(100):
        p = 1 / (1 + np.exp(-np.clip(x @ at, -50, 50)))
        gradient = x.T @ (p - toxic) + weight * at
        step = np.linalg.solve((x * (p * (1 - p))[:, None]).T @ x + np.diag(weight), gradient)
        length = 1.0
        while length > 1e-6 and loss(at - length * step) > loss(at):
            length /= 2
        at = at - length * step
        if np.abs(length * step).max() < 1e-9:
            break
    return max(0.0, float(at[0])), float(at[1])


def scored(docs: DataFrame, lexicon: Lexicon, text: str = "text", out: str = "toxicity") -> DataFrame:
    """`docs` with a column `out` of the score and the stems found."""
    ship_code(docs.sparkSession)

    @F.arrow_udf("score double, stems array<string>")
    def score(batches: Iterator[pa.Array]) -> Iterator[pa.Array]:
        for texts in batches:
            made = [lexicon.evidence(t) for t in each_text(texts)]
            yield pa.StructArray.from_arrays([pa.array([lexicon.score(e) for e, _ in made], pa.float64()), pa.array([s for _, s in made], pa.list_(pa.string()))], names=["score", "stems"])
        give_back()

    return docs.withColumn(out, score(F.col(text)))
