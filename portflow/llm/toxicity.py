"""Toxicity scores from a lexicon, its misspellings and their context.

The lexicon is learned: words that labelled toxic documents hold far more often than others. Its terms form a trie. A
word of a text is run against it by an automaton whose states are (trie node, letters read, edits left), one edit
allowed; a state from which no term is within reach is not entered. What stands between blanks is also matched as a
whole, its outer punctuation aside, so that a digit or sign within hides no term. Each hit is scored in the window of
words around it: quotation marks or words that report make it quotation, others abuse. Words that report are a few fixed
ones and those learned: words that stand by terms far more often where the label says that nothing is toxic.

A logistic model over these scores gives the result. Misspellings of short words, which are often other words, are a
score of their own, whatever stands around them, so that the labels decide what they weigh. All of this is fitted on at most TRAIN_ROWS labels, those
of the smallest hash; the lexicon has no cap of its own, as every term has LEAST_DOCS labelled documents at least.

Null text counts as empty. Rows without a doc_id are scored and never held out. Labels that repeat a doc_id count as
often as they occur; of documents that repeat one, the text of the smallest hash is learned from, and all are scored.
Of equally near terms the heaviest is the hit. Without labels of both kinds every document gets the share of toxic
labels, or 0 without labels. Other columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from portflow.llm.shared import text_of, written

TRAIN_ROWS, LEAST_DOCS, LEAST_ODDS = 20_000, 3, 12.0
#: Misspellings count from FUZZY_FROM letters on, as those of short words below SHORT_BELOW (whole chunks: below MASKED_FROM).
WINDOW, FUZZY_FROM, SHORT_BELOW, MASKED_FROM, CACHE_WORDS = 6, 3, 5, 4, 1_000_000
FEATURES = 9
#: Words of report in the languages of the corpus, and quotation marks.
REPORT = frozenset("said says say quote quoted quotes called wrote word term sagte sagt zitat zitiert wort dit disait mot citation dijo dice palabra cita".split())
MARKS = frozenset("\"'“”„«»‘’`")
_WORD = re.compile(r"[^\W\d_]+")
_WHOLE = re.compile(r"[^\W_](?:.*[^\W_])?", re.S)
_NEAR_MARK = 3


def shortened(word: str) -> set[str]:
    """The word and what is left of it without one letter."""
    return {word, *(word[:i] + word[i + 1 :] for i in range(len(word)))}


class Trie:
    """Terms with weights. match() gives the best term within `edits` edits, as (weight, distance)."""

    def __init__(self, terms: dict[str, float]):
        self.root: dict = {}
        self.terms = terms
        self.near = set().union(*map(shortened, terms))
        self.halves: dict[int, tuple[set[str], set[str]]] = {}
        for term, weight in terms.items():
            node = self.root
            for c in term:
                node = node.setdefault(c, {})
            node[""] = weight
            half = len(term) // 2
            for n in (len(term) - 1, len(term), len(term) + 1):  # the lengths of words one edit away
                heads, tails = self.halves.setdefault(n, (set(), set()))
                heads.add(term[:half])
                tails.add(term[half:])

    def within_one(self, word: str) -> bool:
        """Whether a term can be one edit away: an edit leaves the first or the second half of the term as it is, and one letter
        less, or none, makes some form of both the same."""
        n = len(word)
        heads, tails = self.halves.get(n, ((), ()))
        a, b = n // 2, (n + 1) // 2
        if not heads or not (word[: (n - 1) // 2] in heads or word[:a] in heads or word[:b] in heads or word[n - a :] in tails or word[n - b :] in tails or word[n - (n + 2) // 2 :] in tails):
            return False
        return not self.near.isdisjoint(shortened(word))

    def match(self, word: str, edits: int = 1, least: int = FUZZY_FROM) -> tuple[float, int] | None:
        if word in self.terms:
            return self.terms[word], 0
        if len(word) < least or not edits or edits == 1 and not self.within_one(word):
            return None
        best: tuple[int, float] | None = None
        stack = [(self.root, 0, edits)]  # automaton: (trie node, letters read, edits left)
        while stack:
            node, i, left = stack.pop()
            while True:
                if i == len(word) and "" in node and (best is None or (edits - left, -node[""]) < best):
                    best = (edits - left, -node[""])
                if left:
                    last = left == 1  # then the letters that follow must be there; "" is the end of a word and of a term
                    this = word[i] if i < len(word) else ""
                    following = word[i + 1] if i + 1 < len(word) else ""
                    for c, child in node.items():
                        if c:
                            if not last or this in child:
                                stack.append((child, i, left - 1))
                            if this and c != this and (not last or following in child):
                                stack.append((child, i + 1, left - 1))
                    if this and (not last or following in node):
                        stack.append((node, i + 1, left - 1))
                if i == len(word) or word[i] not in node:
                    break
                node, i = node[word[i]], i + 1
        return None if best is None else (-best[1], best[0])


@dataclass
class Model:
    terms: dict[str, float]
    cues: frozenset[str] = REPORT
    weights: list[float] = field(default_factory=lambda: [0.0] * FEATURES)
    bias: float = -20.0


@dataclass(frozen=True)
class Hit:
    word: str
    weight: float
    distance: int
    short: bool = False


def hit_of(chunk: str, trie: Trie) -> Hit | None:
    """The best hit among a chunk between blanks, its outer punctuation aside, and the words in it."""
    words = [(word, SHORT_BELOW) for word in _WORD.findall(chunk)]
    if (whole := _WHOLE.search(chunk)) and not whole[0].isalpha():
        words.append((whole[0], MASKED_FROM))
    hits = [Hit(word, *m, bool(m[1]) and len(word) < below) for word, below in words if (m := trie.match(word))]
    return min(hits, key=lambda h: (h.distance, h.short, -h.weight)) if hits else None


def _hits(chunks: list[str], trie: Trie, cache: dict) -> dict[str, Hit]:
    """The hits among the chunks. cache: chunks met before, with their hits."""
    distinct = set(chunks)
    new = distinct.difference(cache)
    if len(cache) + len(new) > CACHE_WORDS:
        cache.clear()
        new = distinct
    for w in new:
        cache[w] = hit_of(w, trie)
    return {w: cache[w] for w in distinct if cache[w] is not None}


def _bare(chunk: str) -> str:
    return chunk.strip(",.;:!?\"'")


def features(text: str, trie: Trie, cache: dict, cues: frozenset[str] = REPORT) -> list[float]:
    """Counts and weights of hits, exact and misspelled, in quotation and not."""
    chunks = text.lower().split()
    found = _hits(chunks, trie, cache)
    if not found:
        return [0.0] * FEATURES
    exact = fuzzy = quoted = short = 0
    exact_weight = fuzzy_weight = 0.0
    kinds = set()
    for i, chunk in enumerate(chunks):
        if chunk not in found:
            continue
        hit = found[chunk]
        if hit.short:
            short += 1
            continue
        before, after = chunks[max(0, i - WINDOW) : i], chunks[i + 1 : i + 1 + WINDOW]
        opened = any(c[0] in MARKS for c in [*before[-_NEAR_MARK:], chunk])
        closed = any(c.rstrip(",.;:!?")[-1:] in MARKS for c in [chunk, *after[:_NEAR_MARK]])
        if opened and closed or any(_bare(c) in cues for c in before + after):
            quoted += 1
        elif hit.distance:
            fuzzy, fuzzy_weight = fuzzy + 1, fuzzy_weight + hit.weight
        else:
            exact, exact_weight = exact + 1, exact_weight + hit.weight
            kinds.add(hit.word)
    n = max(1, len(chunks))
    return [
        math.log1p(exact), math.log1p(exact_weight), math.log1p(fuzzy), math.log1p(fuzzy_weight),
        math.log1p(quoted), math.log1p(len(kinds)), math.log1p(1000 * exact / n), math.log1p(1000 * fuzzy / n), math.log1p(1000 * short / n),
    ]


def _tilted(counts: DataFrame, sizes: tuple[int, int]) -> DataFrame:
    """counts (word, a, b), in documents of two classes of these sizes: (word, w) of those far more frequent in the first."""
    odds = F.log((F.col("a") + 0.5) / F.lit(sizes[0] + 1.0)) - F.log((F.col("b") + 0.5) / F.lit(sizes[1] + 1.0))
    return counts.where(F.col("a") >= LEAST_DOCS).select("word", odds.alias("w")).where(F.col("w") >= math.log(LEAST_ODDS))


def _by_label(words: DataFrame) -> DataFrame:
    toxic = F.when(F.col("toxic") == 1, 1).otherwise(0)
    return words.groupBy("word").agg(F.sum(toxic).alias("a"), F.sum(1 - toxic).alias("b"))


def _sizes(labelled: DataFrame) -> tuple[int, int]:
    return tuple(labelled.agg(F.count_if(F.col("toxic") == 1), F.count_if(F.col("toxic") != 1)).first())


def learn_terms(labelled: DataFrame) -> dict[str, float]:
    """From (row, text, toxic): terms and their log-odds. Documents are counted in Spark."""
    sizes = _sizes(labelled)
    if not all(sizes):
        return {}
    word = F.explode(F.array_distinct(F.expr(r"regexp_extract_all(lower(text), '[\\p{L}]+', 0)"))).alias("word")
    return {r["word"]: float(r["w"]) for r in _tilted(_by_label(labelled.select("toxic", word)), sizes).collect()}


def learn_cues(labelled: DataFrame, terms: dict[str, float]) -> frozenset[str]:
    """REPORT, and the words that stand near a term in far more documents with the label 0 than in others, by documents that hold a term."""
    shared = labelled.sparkSession.sparkContext.broadcast(terms)

    def near(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, cache = Trie(shared.value), {}
        for batch in batches:
            rows = []
            for toxic, text in zip(batch.column("toxic").to_pylist(), batch.column("text").to_pylist(), strict=True):
                chunks = text.lower().split()
                found = _hits(chunks, trie, cache)
                at = [i for i, c in enumerate(chunks) if c in found] if found else []
                words = {_bare(c) for i in at for c in chunks[max(0, i - WINDOW) : i + 1 + WINDOW] if c not in found}
                rows += [(toxic, w) for w in ({""} if at else set()) | words]  # "" counts the document itself
            yield pa.RecordBatch.from_arrays([pa.array([t for t, _ in rows], pa.int32()), pa.array([w for _, w in rows], pa.string())], ["toxic", "word"])

    counts = written(_by_label(labelled.select("toxic", "text").mapInArrow(near, "toxic int, word string")))
    whole = counts.where("word = ''").first()
    if whole is None or not whole["a"] or not whole["b"]:
        return REPORT
    clean_first = counts.where("word <> ''").select("word", F.col("b").alias("a"), F.col("a").alias("b"))
    return REPORT | {r["word"] for r in _tilted(clean_first, (whole["b"], whole["a"])).collect()}


def fit(labelled: DataFrame) -> Model:
    """labelled (row, text, toxic), about TRAIN_ROWS rows. Each half gives terms and cues for the other's scores, to which weights are fitted."""
    labelled = written(labelled)
    share = labelled.agg(F.avg("toxic")).first()[0]
    if share is None or share in (0.0, 1.0):
        p = min(max(share or 0.0, 1e-9), 1 - 1e-9)
        return Model({}, bias=math.log(p / (1 - p)))
    half = F.pmod(F.xxhash64("row", F.lit("half")), F.lit(2))
    crossed = []
    for k in (0, 1):
        other = labelled.where(half != k)
        terms = learn_terms(other)
        crossed.append(_featured(labelled.where(half == k).select("row", "text", "toxic"), terms, learn_cues(other, terms), ["row", "toxic"]))
    rows = crossed[0].unionAll(crossed[1]).toPandas()  # TRAIN_ROWS rows of FEATURES numbers
    x = np.array(rows["x"].tolist()).reshape(-1, FEATURES)
    y = rows["toxic"].to_numpy(float)
    terms = learn_terms(labelled)
    return Model(terms, learn_cues(labelled, terms), *logistic(x, y))


def logistic(x: np.ndarray, y: np.ndarray, ridge: float = 1e-2) -> tuple[list[float], float]:
    z = np.concatenate([x, np.ones((len(x), 1))], axis=1)
    w, hold = np.zeros(z.shape[1]), np.full(z.shape[1], ridge)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(z @ w, -30, 30)))
        step = np.linalg.solve((z * (p * (1 - p))[:, None]).T @ z + np.diag(hold), z.T @ (p - y) + hold * w)
        w -= step
        if abs(step).max() < 1e-8:
            break
    return w[:-1].tolist(), float(w[-1])


def _featured(rows: DataFrame, terms: dict[str, float], cues: frozenset[str], keep: list[str]) -> DataFrame:
    """rows (keep..., text) with the features x instead of text."""
    shared = rows.sparkSession.sparkContext.broadcast((terms, cues))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, cache = Trie(shared.value[0]), {}
        for batch in batches:
            x = [features(t or "", trie, cache, shared.value[1]) for t in batch.column("text").to_pylist()]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in keep), pa.array(x, pa.list_(pa.float64()))], [*keep, "x"])

    return rows.select(*keep, "text").mapInArrow(run, rows.select(*keep, F.array(F.lit(0.0)).alias("x")).schema)


def score(docs: DataFrame, model: Model) -> DataFrame:
    """(doc_id, score) of every document."""
    got = _featured(docs.select(F.col("doc_id").cast("long"), text_of().alias("text")), model.terms, model.cues, ["doc_id"])
    z = sum((F.lit(w) * F.col("x")[i] for i, w in enumerate(model.weights)), F.lit(model.bias))
    return got.select("doc_id", (F.lit(1.0) / (F.lit(1.0) + F.exp(-z))).alias("score"))


def held_out(doc_id: F.Column) -> F.Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def scored_documents(docs: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> DataFrame:
    """Per document doc_id, held_out, score and predicted; held-out rows lend no label."""
    known = labels.where("toxic in (0, 1) and doc_id is not null").select(F.col("doc_id").cast("long"), F.col("toxic").cast("int"))
    known = known.where(~held_out(F.col("doc_id"))).orderBy(F.xxhash64("doc_id"), "doc_id", "toxic").limit(train_rows)  # two numbers a row
    asked = F.broadcast(known.select("doc_id").distinct())
    texts = docs.select(F.col("doc_id").cast("long"), text_of().alias("text")).join(asked, "doc_id", "left_semi")
    texts = texts.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("t")).select("doc_id", "t.text")
    model = fit(texts.join(F.broadcast(known), "doc_id").withColumnRenamed("doc_id", "row"))
    out = score(docs, model)
    return out.select("doc_id", held_out(F.col("doc_id")).alias("held_out"), "score", (F.col("score") >= 0.5).cast("int").alias("predicted"))
