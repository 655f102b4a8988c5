"""Toxicity: a learned lexicon, met through Levenshtein automata, with the context of every hit.

The lexicon is learned from labelled documents: whole words, and beginnings of
longer words that go on in several ways, which toxic documents have far more
often than others. A term must stand
after many different words, so that copies of one document do not make terms of
all its words. The terms form a trie. The Levenshtein automaton of all terms is
run on the trie: a state is the set of trie nodes that the letters read so far
can have reached, with the edits this took. States are made deterministic when
they are first met. How much a misspelled form counts is learned as well, from
the words that match a term with so many edits in clean and in toxic documents.

A window of words around each hit decides between quotation and abuse: quotation
marks on both sides and words of reporting speak for a quotation, a second person
and further hits for abuse. A regression on what is left of the hits gives the
score of the document.

Bounds, all parameters: lexicon and regression come from at most `labelled`
labelled documents, those with the smallest hashes of their ids, a fifth of them
kept for the regression; of the candidate terms the `terms` clearest are used.
Every document is scored on its whole text.

Defined cases: a null text is empty; labels without toxic or of ids that no
document has are left out; several labels of one id count as toxic if one is; of
several texts of one id the smallest is learned from; without labels of both
kinds every document gets the share of toxic labels (0 without labels); every
input row gives a row; an empty table gives no rows; other columns are ignored.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from keptvisit.llm.quality import fit_logistic, word_lists
from keptvisit.session import write_out

LABELLED, TERMS, CANDIDATES = 8000, 400, 4000
LEAST_SEEN, LEAST_SHARE, LEAST_Z = 8, 0.3, 7.0
LEAST_WORD, LEAST_STEM = 3, 4
# A beginning is a term of its own if no single way to go on has more than this share of it.
ONE_WAY = 0.7
# What a form with one and two edits counts before any was seen.
TRUST = (0.95, 0.7, 0.5)
WINDOW = 8
THRESHOLD = 0.7
RIDGE = 0.1
FEATURES = 3
CACHE = 400_000

# Words of reporting and of the second person in four languages.
REPORTING = frozenset(
    "said says wrote writes called calls quote quoted quotes term word example means "
    "sagte sagt schrieb nannte wort zitat zitiert beispiel bedeutet "
    "écrit écrivait appelé citation cité exemple signifie "
    "dijo dice escribió llamó palabra cita citado ejemplo significa".split())
SECOND_PERSON = frozenset(
    "you your yours du dich dir dein deine ihr euch tu toi vous votre usted ustedes tú eres".split())
QUOTES = frozenset("\"“”«»„‟‹›")
# Quotation marks on both sides, words of reporting, a second person, further hits, and none of these.
CONTEXT = {"marks": 2.5, "reporting": 1.5, "person": -1.0, "hits": -0.7, "base": -2.0}

_TOKEN = re.compile(r"[^\W_]+|[\"“”«»„‟‹›]")


def allowed_edits(length: int, stem: bool) -> int:
    if length < 5:
        return 0
    return 1 if stem or length < 8 else 2


@dataclass(frozen=True)
class Term:
    """A word, or with `stem` a beginning of words, and the trust in a match per number of edits."""

    text: str
    stem: bool
    trust: tuple[float, ...] = TRUST

    @property
    def edits(self) -> int:
        return allowed_edits(len(self.text), self.stem)


class Automaton:
    """The Levenshtein automata of all terms on their trie, made deterministic as words are read."""

    def __init__(self, terms: list[Term]) -> None:
        self.terms = terms
        self.children: list[dict[str, int]] = [{}]
        self.ends: list[list[int]] = [[]]
        self.most: list[int] = [0]
        self.onward: dict[int, int] = {}
        for number, term in enumerate(terms):
            at = 0
            self.most[0] = max(self.most[0], term.edits)
            for letter in term.text:
                if letter not in self.children[at]:
                    self.children[at][letter] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.most.append(0)
                at = self.children[at][letter]
                self.most[at] = max(self.most[at], term.edits)
            if term.stem:
                # A beginning is met when at least one more letter follows, whichever they are.
                if at not in self.onward:
                    self.onward[at] = len(self.children)
                    self.onward[len(self.children)] = len(self.children)
                    self.children.append({})
                    self.ends.append([])
                    self.most.append(0)
                at = self.onward[at]
                self.most[at] = term.edits
            self.ends[at].append(number)
        self.states: dict[frozenset, int] = {}
        self.sets: list[frozenset] = []
        self.steps: list[dict[str, int]] = []
        self.found: list[tuple[int, int] | None] = []
        self.start = self._state({0: 0})

    def _state(self, reached: dict[int, int]) -> int:
        """The number of a state; letters that the word lacks are skipped first. -1 if nothing is reached."""
        open_, best = list(reached.items()), dict(reached)
        while open_:
            node, edits = open_.pop()
            if best[node] < edits:
                continue
            for child in self.children[node].values():
                if edits < self.most[child] and edits + 1 < best.get(child, 99):
                    best[child] = edits + 1
                    open_.append((child, edits + 1))
        if not best:
            return -1
        key = frozenset(best.items())
        if key not in self.states:
            self.states[key] = len(self.sets)
            self.sets.append(key)
            self.steps.append({})
            hits = [(edits, -self.terms[t].trust[edits], t) for node, edits in best.items()
                    for t in self.ends[node] if edits <= self.terms[t].edits]
            self.found.append((min(hits)[2], min(hits)[0]) if hits else None)
        return self.states[key]

    def _step(self, state: int, letter: str) -> int:
        reached: dict[int, int] = {}

        def reach(node: int, edits: int) -> None:
            if edits <= self.most[node] and edits < reached.get(node, 99):
                reached[node] = edits

        for node, edits in self.sets[state]:
            if node in self.onward:
                reach(self.onward[node], edits)
            reach(node, edits + 1)
            for own, child in self.children[node].items():
                reach(child, edits + (own != letter))
        to = self._state(reached)
        self.steps[state][letter] = to
        return to

    def match(self, word: str) -> tuple[int, int] | None:
        """The closest term and its edits."""
        state = self.start
        for letter in word:
            to = self.steps[state].get(letter)
            state = self._step(state, letter) if to is None else to
            if state < 0:
                return None
        return self.found[state]


@dataclass(frozen=True)
class Hit:
    """A term met in a text: code points, edits, and how likely it is quoted."""

    start: int
    end: int
    term: int
    edits: int
    quotation: float


def in_context(text: str, known: dict[str, tuple[int, int]], window: int = WINDOW) -> list[Hit]:
    """The hits of a text, each with the score of the window around it."""
    tokens = list(_TOKEN.finditer(text))
    words = [t.group().lower() for t in tokens]
    at = [n for n, word in enumerate(words) if word in known]
    hits = []
    for n in at:
        left, right = words[max(0, n - window):n], words[n + 1:n + 1 + window]
        marks = any(w in QUOTES for w in left) and any(w in QUOTES for w in right)
        around = left + right
        score = CONTEXT["base"] + CONTEXT["marks"] * marks + CONTEXT["reporting"] * any(
            w in REPORTING for w in around) + CONTEXT["person"] * any(
            w in SECOND_PERSON for w in around) + CONTEXT["hits"] * min(3, sum(w in known for w in around))
        term, edits = known[words[n]]
        hits.append(Hit(tokens[n].start(), tokens[n].end(), term, edits, 1 / (1 + float(np.exp(-score)))))
    return hits


@dataclass
class Model:
    """The lexicon and the regression; `weights` is None without labels of both kinds."""

    terms: list[Term]
    weights: np.ndarray | None
    share: float
    _automaton: Automaton | None = field(default=None, repr=False)
    _cache: dict = field(default_factory=dict, repr=False)

    def __getstate__(self):
        return {"terms": self.terms, "weights": self.weights, "share": self.share, "_automaton": None, "_cache": {}}

    def match(self, word: str) -> tuple[int, int] | None:
        if word in self._cache:
            return self._cache[word]
        if self._automaton is None or len(self._automaton.sets) > CACHE:
            self._automaton = Automaton(self.terms)
        if len(self._cache) > CACHE:
            self._cache.clear()
        found = self._cache[word] = self._automaton.match(word)
        return found

    def hits(self, texts: pa.Array) -> list[list[Hit]]:
        lists = word_lists(texts)
        flat = lists.flatten().dictionary_encode()
        known = {w: m for w in flat.dictionary.to_pylist() if (m := self.match(w)) is not None}
        out: list[list[Hit]] = [[] for _ in range(len(texts))]
        if not known:
            return out
        is_hit = np.array([w in known for w in flat.dictionary.to_pylist()])[np.asarray(flat.indices)]
        owner = np.repeat(np.arange(len(texts)), np.asarray(lists.value_lengths()))
        for at in np.unique(owner[is_hit]).tolist():
            out[at] = in_context(texts[at].as_py(), known)
        return out

    def features(self, texts: pa.Array, hits: list[list[Hit]]) -> np.ndarray:
        """Per text the clearest hit, the sum of all and their sum per hundred words, as evidence of abuse.

        The evidence of a hit is how far its log-odds lie above those of any document.
        """
        out = np.zeros((len(hits), FEATURES))
        for at, own in enumerate(hits):
            if not own:
                continue
            trust = np.array([self.terms[h.term].trust[h.edits] for h in own])
            odds = np.log(trust / (1 - trust)) - np.log(self.share / (1 - self.share))
            abuse = np.array([1 - h.quotation for h in own]) * np.clip(odds, 0, 6)
            words = texts[at].as_py().count(" ") + 1
            out[at] = abuse.max(), np.log1p(abuse.sum()), np.log1p(100 * abuse.sum() / words)
        return out

    def scores(self, texts: pa.Array, hits: list[list[Hit]]) -> np.ndarray:
        if self.weights is None:
            return np.full(len(hits), self.share)
        x = self.features(texts, hits)
        return 1 / (1 + np.exp(-np.clip(x @ self.weights[:-1] + self.weights[-1], -35, 35)))


def remainder(id: str) -> Column:
    return F.coalesce(F.crc32(F.col(id).cast("string").cast("binary")) % 3, F.lit(0))


def _word_counts(sample: DataFrame) -> DataFrame:
    """Per word the toxic and the clean documents that have it."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[bool, Counter] = {True: Counter(), False: Counter()}
        for batch in batches:
            lists = word_lists(batch.column("text"))
            for toxic, own in zip(batch.column("toxic").to_pylist(), lists):
                counts[toxic].update(own.values.unique().to_pylist())
        words = sorted(counts[True].keys() | counts[False].keys())
        if words:
            yield pa.RecordBatch.from_arrays(
                [pa.array(words), *[pa.array([counts[t][w] for w in words], pa.int64()) for t in (True, False)]],
                ["word", "toxic", "clean"])

    return write_out(
        sample.mapInArrow(run, "word string, toxic long, clean long").filter("word != ''").groupBy("word").agg(
            F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")), "words")


def _candidates(words: DataFrame, base: float, most: int) -> list[tuple[str, bool, float]]:
    """Words and beginnings that stand out as toxic: text, stem, and how far from chance."""
    n = F.col("toxic") + F.col("clean")
    z = ((F.col("toxic") - base * n) / F.sqrt(n * base * (1 - base))).alias("z")
    clear = (F.col("toxic") >= LEAST_SEEN) & (F.col("toxic") >= LEAST_SHARE * n) & (F.col("z") >= LEAST_Z)
    whole = words.filter(F.length("word") >= LEAST_WORD).select(
        F.col("word").alias("text"), F.lit(False).alias("stem"), "toxic", "clean", z).filter(clear)
    longer = words.filter(F.length("word") > LEAST_STEM).select(
        F.explode(F.expr(f"sequence({LEAST_STEM}, length(word) - 1)")).alias("size"), "word", "toxic", "clean").select(
        F.expr("substring(word, 1, size)").alias("text"), F.expr("substring(word, size + 1, 1)").alias("next"),
        "toxic", "clean")
    stems = longer.groupBy("text", "next").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).groupBy("text").agg(
        F.max("toxic").alias("way"), F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).filter(
        F.col("way") <= ONE_WAY * F.col("toxic")).select(
        "text", F.lit(True).alias("stem"), "toxic", "clean", z).filter(clear)
    rows = whole.unionByName(stems).orderBy(F.desc("z"), "text", "stem").limit(most).collect()
    return [(r["text"], r["stem"], r["z"]) for r in rows]


def _after_many_words(sample: DataFrame, found: list[tuple[str, bool, float]]) -> set[tuple[str, bool]]:
    """The candidates that stand after at least LEAST_SEEN different words, mostly in toxic documents."""
    whole = {text for text, stem, _ in found if not stem}
    begin = {text for text, stem, _ in found if stem}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            seen = set()
            for toxic, own in zip(batch.column("toxic").to_pylist(), word_lists(batch.column("text")).to_pylist()):
                own = [w for w in own if w]
                for before, word in zip(["", *own], own):
                    if word in whole:
                        seen.add((word, False, before, toxic))
                    for size in range(LEAST_STEM, len(word)):
                        if word[:size] in begin:
                            seen.add((word[:size], True, before, toxic))
            if seen:
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c) for c in zip(*sorted(seen))], ["text", "stem", "before", "toxic"])

    n = F.sum(F.col("toxic").cast("long"))
    kept = sample.mapInArrow(run, "text string, stem boolean, before string, toxic boolean").distinct().groupBy(
        "text", "stem").agg(n.alias("toxic"), F.count(F.lit(1)).alias("n")).filter(
        (F.col("toxic") >= LEAST_SEEN) & (F.col("toxic") >= LEAST_SHARE * F.col("n")))
    return {(r["text"], r["stem"]) for r in kept.collect()}


def _with_trust(terms: list[Term], words: DataFrame) -> list[Term]:
    """Terms with the trust that the words of the sample give to each number of edits."""
    model = Model(terms, None, 0.0)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [(m, t, c) for w, t, c in zip(*[batch.column(n).to_pylist() for n in ("word", "toxic", "clean")])
                     if (m := model.match(w)) is not None]
            if found:
                yield pa.RecordBatch.from_arrays(
                    [pa.array([m[0] for m, _, _ in found], pa.int32()), pa.array([m[1] for m, _, _ in found], pa.int32()),
                     pa.array([t for _, t, _ in found], pa.int64()), pa.array([c for _, _, c in found], pa.int64())],
                    ["term", "edits", "toxic", "clean"])

    rows = words.mapInArrow(run, "term int, edits int, toxic long, clean long").groupBy("term", "edits").agg(
        F.sum("toxic").alias("toxic"), F.sum("clean").alias("clean")).collect()
    trust = [list(TRUST) for _ in terms]
    for r in rows:
        prior = TRUST[r["edits"]]
        trust[r["term"]][r["edits"]] = (r["toxic"] + prior) / (r["toxic"] + r["clean"] + 1)
    return [Term(t.text, t.stem, tuple(own)) for t, own in zip(terms, trust)]


def learn_terms(sample: DataFrame, terms: int = TERMS) -> list[Term]:
    """The lexicon of a labelled sample (text, toxic)."""
    base = sample.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if not base or base == 1:
        return []
    words = _word_counts(sample)
    found = _candidates(words, float(base), CANDIDATES)
    if not found:
        return []
    steady = _after_many_words(sample, found)
    chosen: list[tuple[str, bool]] = []
    taken: set[str] = set()
    # A beginning stands for all words and longer beginnings that it covers.
    for text, stem, _ in sorted((f for f in found if f[:2] in steady), key=lambda f: (len(f[0]), not f[1], f[0])):
        if any(text[:size] in taken for size in range(1, len(text))):
            continue
        chosen.append((text, stem))
        if stem:
            taken.add(text)
    z = {f[:2]: f[2] for f in found}
    best = sorted(chosen, key=lambda c: (-z[c], c))[:terms]
    return _with_trust([Term(text, stem) for text, stem in sorted(best)], words)


def fit(
    docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", text: str = "text", label: str = "toxic",
    learns: Column | None = None, labelled: int = LABELLED, terms: int = TERMS,
) -> Model:
    """A model from a bounded sample of the labelled documents for which `learns` (on labels) holds."""
    rows = labels.filter(F.col(label).isNotNull() & F.col(id).isNotNull())
    truth = (rows if learns is None else rows.filter(learns)).select(
        F.col(id).cast("long").alias("_id"), (F.col(label) == 1).alias("toxic")).groupBy("_id").agg(
        F.max("toxic").alias("toxic"))
    ids = docs.select(F.col(id).cast("long").alias("_id")).distinct().join(truth, "_id")
    chosen = write_out(ids.orderBy(F.xxhash64(F.lit("toxic"), "_id"), "_id").limit(labelled), "chosen")
    own = docs.select(F.col(id).cast("long").alias("_id"), F.coalesce(
        F.col(text).cast("string"), F.lit("")).alias("text"))
    sample = write_out(
        own.join(F.broadcast(chosen), "_id").groupBy("_id", "toxic").agg(F.min("text").alias("text")), "sample")
    share = sample.agg(F.avg(F.col("toxic").cast("double"))).first()[0]
    if share in (None, 0.0, 1.0):
        return Model([], None, float(share or 0))
    late = F.pmod(F.xxhash64(F.lit("late"), "_id"), F.lit(5)) == 0
    kinds = sample.filter(late).agg(F.count_distinct("toxic")).first()[0]
    early = sample.filter(~late) if kinds == 2 else sample
    model = Model(learn_terms(early, terms), None, float(share))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            x = model.features(batch.column("text"), model.hits(batch.column("text")))
            yield pa.RecordBatch.from_arrays(
                [pa.array(x[:, k]) for k in range(FEATURES)] + [batch.column("toxic").cast(pa.float64())], ["a", "b", "c", "y"])

    # Bounded by the sample's size.
    found = (sample.filter(late) if kinds == 2 else sample).mapInArrow(
        run, "a double, b double, c double, y double").toArrow()
    x = np.stack([np.asarray(found.column(c)) for c in "abc"], axis=1)
    model.weights = fit_logistic(x, np.asarray(found.column("y")), np.ones(len(x)), RIDGE)
    return model


_HITS = "array<struct<start: int, end: int, term: string, edits: int, quotation: double>>"


def detect(docs: DataFrame, model: Model, carried: list, *, text: str = "text") -> DataFrame:
    """The `carried` columns of every row with its score and hits."""
    rows = docs.select(*carried, F.coalesce(F.col(text).cast("string"), F.lit("")).alias("_text"))
    kept = rows.columns[:-1]
    kind = pa.list_(pa.struct([("start", pa.int32()), ("end", pa.int32()), ("term", pa.string()),
                               ("edits", pa.int32()), ("quotation", pa.float64())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 300):
                part = batch.slice(at, 300)
                hits = model.hits(part.column("_text"))
                told = [[{"start": h.start, "end": h.end, "term": model.terms[h.term].text, "edits": h.edits,
                          "quotation": h.quotation} for h in own] for own in hits]
                yield pa.RecordBatch.from_arrays(
                    [*[part.column(c) for c in kept], pa.array(model.scores(part.column("_text"), hits)), pa.array(told, kind)],
                    [*kept, "score", "hits"])

    fields = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in rows.select(*kept).schema)
    return rows.mapInArrow(run, f"{fields}, score double, hits {_HITS}")


def classify(docs: DataFrame, labels: DataFrame, *, id: str = "doc_id", threshold: float = THRESHOLD, **names) -> DataFrame:
    """id, held_out, score, predicted and n_hits of every document; labels of held-out ones are not read."""
    model = fit(docs, labels, id=id, learns=remainder(id) != 1, **names)
    rows = detect(docs, model, [F.col(id).alias("id")], text=names.get("text", "text"))
    return rows.select(
        F.col("id").alias(id), (remainder("id") == 1).alias("held_out"), "score",
        (F.col("score") >= threshold).cast("int").alias("predicted"), F.size("hits").alias("n_hits"))
