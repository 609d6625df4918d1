"""Toxicity by a learnt lexicon that is matched with spelling errors, and by what stands around a match.

The lexicon is a trie of whole words and of word stems, learnt from labelled documents. Words of a text run through the
Levenshtein automata of all terms at once: a state is a set of (trie node, errors so far), made when a word first
leads there, so every character of every distinct word is one step in a table. A whole word may be misspelled by one
error, by two from eight letters on; a stem has to stand as it is, with any ending. A match counts by its
term's log-odds, less by distance, and by the chance that its window speaks abuse and not a quotation: log-odds of
the words around, and quotation marks. A document's matches become a few features of a logistic regression, which is
fitted on documents that its lexicon was not learnt from.
"""

from __future__ import annotations

import re
import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import kept, mapped, sample_of, slices, text_frame

TRAIN_ROWS = 20_000  # labelled documents that are learnt from, at most; those of the least hashes
CANDIDATES = 200_000  # words and stems of toxic training documents that are counted, the most frequent ones
TERMS = 256  # of a lexicon, the most telling ones
STEM_LENGTHS = range(4, 11)
LONGEST = 24  # letters of a term
LEAST_DOCUMENTS, LEAST_GAIN, LEAST_ODDS = 3, 18.0, 1.2  # that a term is in; its log-likelihood ratio; its log-odds
NEAR = (1.0, 0.6, 0.4)  # what a term's weight counts at zero, one and two errors
WINDOW, BUCKETS = 4, 1024  # words looked at on either side of a match; buckets of their hashes
SHRINK, QUOTED_PRIOR = 5.0, -3.0
CACHE_WORDS = 300_000  # words with their weights that a Python worker remembers; then it starts again with none
STATES = 50_000  # of the automaton; then it starts again
PART = 1 << 20  # characters of a text looked at together

#: A run of letters and digits; a masking sign between two of them is part of the word.
WORD = re.compile(r"[^\W_]+(?:[*@$!#][^\W_]+)*")
QUOTES = "\"“”„«»‘’`'"
END = "\0"


def errors_allowed(term: str) -> int:
    """Of a whole word, which ends with END."""
    if not term.endswith(END):
        return 0
    return 2 if len(term) > 8 else 1 if len(term) > 4 else 0


class Automaton:
    """The Levenshtein automata of a lexicon, united along its trie and made deterministic as words come."""

    def __init__(self, terms: list[str]):
        self.children: list[dict[str, int]] = [{}]
        self.most = [0]  # errors that some term below the node allows
        self.ends: dict[int, int] = {}  # node to term
        for i, term in enumerate(terms):
            node, allowed = 0, errors_allowed(term)
            self.most[0] = max(self.most[0], allowed)
            for c in term:
                if c not in self.children[node]:
                    self.children[node][c] = len(self.children)
                    self.children.append({})
                    self.most.append(0)
                node = self.children[node][c]
                self.most[node] = max(self.most[node], allowed)
            self.ends[node] = i
        self.terms = terms
        self.alphabet = np.array(sorted({ord(c) for term in terms for c in term if c != END}), np.uint32)
        self.width = max([len(t) for t in terms], default=0) + 2
        self.start_over()

    def start_over(self) -> None:
        self.classes = len(self.alphabet) + 2  # any other character, the alphabet, the end
        self.sets: list[dict[int, int]] = [{}]  # node to its fewest errors; state 0 is dead
        self.number: dict[tuple, int] = {(): 0}
        self.table = np.full((256, self.classes), -1, np.int32)
        self.term = np.full(256, -1, np.int32)  # accepted in a state
        self.errors = np.zeros(256, np.int8)
        self.table[0] = 0
        self.start = self.state(self.closed({0: 0}))

    def closed(self, nodes: dict[int, int]) -> dict[int, int]:
        """With letters of a term left out."""
        todo = list(nodes)
        while todo:
            node = todo.pop()
            errors = nodes[node] + 1
            for c, child in self.children[node].items():
                if c != END and errors <= self.most[child] and errors < nodes.get(child, 99):
                    nodes[child] = errors
                    todo.append(child)
        return nodes

    def state(self, nodes: dict[int, int]) -> int:
        key = tuple(sorted(nodes.items()))
        if key in self.number:
            return self.number[key]
        new = self.number[key] = len(self.sets)
        self.sets.append(nodes)
        if new == len(self.table):
            self.table = np.concatenate((self.table, np.full_like(self.table, -1)))
            self.term = np.concatenate((self.term, np.full_like(self.term, -1)))
            self.errors = np.concatenate((self.errors, np.zeros_like(self.errors)))
        found = sorted((e, self.ends[n]) for n, e in nodes.items() if n in self.ends and e <= errors_allowed(self.terms[self.ends[n]]))
        if found:
            self.errors[new], self.term[new] = found[0]
        return new

    def step(self, state: int, kind: int) -> int:
        c = END if kind == self.classes - 1 else chr(self.alphabet[kind - 1]) if kind else None
        out: dict[int, int] = {}

        def reach(node: int, errors: int) -> None:
            if errors <= self.most[node] and errors < out.get(node, 99):
                out[node] = errors

        for node, errors in self.sets[state].items():
            if c in self.children[node]:
                reach(self.children[node][c], errors)
            if c != END:
                reach(node, errors + 1)
                for other, child in self.children[node].items():
                    if other not in (END, c):
                        reach(child, errors + 1)
        return self.state(out if c == END else self.closed(out))

    def match(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Term of each word (-1: none) and its errors: the fewest of a whole word, or else a stem."""
        term, errors = np.full(len(words), -1, np.int32), np.zeros(len(words), np.int8)
        if not self.terms or not words:
            return term, errors
        if len(self.sets) > STATES:
            self.start_over()
        letters = np.array([w[: self.width] for w in words], f"<U{self.width}").view(np.uint32).reshape(len(words), self.width)
        place = np.minimum(np.searchsorted(self.alphabet, letters), max(0, len(self.alphabet) - 1))
        kinds = np.where(self.alphabet[place] == letters, place + 1, 0)
        kinds[letters == 0] = self.classes - 1
        rows, state = np.arange(len(words)), np.full(len(words), self.start)
        for at in range(self.width):
            kind = kinds[rows, at]
            for each in np.unique(state * self.classes + kind):
                s, k = divmod(int(each), self.classes)
                if self.table[s, k] < 0:
                    to = self.step(s, k)
                    self.table[s, k] = to
            state = self.table[state, kind]
            found = self.term[state]
            better = (found >= 0) & ((term[rows] < 0) | (self.errors[state] < errors[rows]) | ((self.errors[state] == errors[rows]) & (kind == self.classes - 1)))
            term[rows[better]], errors[rows[better]] = found[better], self.errors[state[better]]
            rows, state = rows[state > 0], state[state > 0]
            if not len(rows):
                break
        return term, errors


@dataclass
class Lexicon:
    """Terms with their weights, words whose own weight goes before a near term's, and log-odds of window words."""

    terms: list[str]
    weights: list[float]
    known: dict[str, float] = field(default_factory=dict)
    trust: dict[int, float] = field(default_factory=dict)  # in words near a term, where that isn't whole
    context: np.ndarray = field(default_factory=lambda: np.zeros(BUCKETS))
    quoted: float = QUOTED_PRIOR


@dataclass
class Match:
    word: str
    near: int | None  # the term, where errors stand between
    weight: float
    quoted: bool
    window: list[str]


class Reader:
    """Finds a lexicon's matches in texts; keeps what it knows of words."""

    def __init__(self, lexicon: Lexicon):
        self.lexicon, self.automaton = lexicon, Automaton(lexicon.terms)
        self.forget()

    def forget(self) -> None:
        self.weight: dict[str, float] = {}
        self.near: dict[str, int] = {}

    def learn(self, words: list[str]) -> None:
        """Weights of words; of one with a masking sign, that of the whole or of its heaviest part."""
        spelled = [(w, part) for w in words for part in ([w] if w.isalnum() else [w, *re.findall(r"[^\W_]+", w)])]
        term, errors = self.automaton.match([part for _, part in spelled])
        self.weight.update(dict.fromkeys(words, 0.0))
        for i in np.flatnonzero(term >= 0).tolist():
            word, part = spelled[i]
            weight = self.lexicon.weights[term[i]] * NEAR[errors[i]]
            if errors[i]:
                self.near[word] = int(term[i])
                weight = min(weight * self.lexicon.trust.get(int(term[i]), 1.0), self.lexicon.known.get(word, weight))
            self.weight[word] = max(self.weight[word], weight, 1e-9)

    def weigh(self, found: list[list[str]]) -> None:
        if len(self.weight) > CACHE_WORDS:
            self.forget()
        new = list({w for words in found for w in words if w not in self.weight})
        for at in range(0, len(new), 50_000):
            self.learn(new[at : at + 50_000])

    def read(self, texts: list[str]) -> Iterator[tuple[int, list[Match]]]:
        """Number of words and matches of every text, several or parts of a long one at a time."""
        short: list[str] = []
        for text in texts:
            if len(text) <= PART:
                short.append(text)
                continue
            yield from self.read_short(short)
            short = []
            yield self.read_long(text)
        yield from self.read_short(short)

    def read_short(self, texts: list[str]) -> Iterator[tuple[int, list[Match]]]:
        texts = [text.lower() for text in texts]
        found = [WORD.findall(text) for text in texts]
        self.weigh(found)
        for text, words in zip(texts, found, strict=True):
            weights = list(map(self.weight.__getitem__, words))
            yield len(words), self.matches(text, words, weights, 0, len(words)) if any(weights) else []

    def read_long(self, text: str) -> tuple[int, list[Match]]:
        """Parts overlap, so that every match has its whole window."""
        total, matches, at = 0, [], 0
        while at < len(text):
            before, after = max(0, at - 4096), min(len(text), at + PART)
            space = re.compile(r"\s").search(text, after)
            after = space.start() if space else len(text)
            lower = text[at:after].lower()
            head, tail = text[before:at].lower(), text[after : after + 4096].lower()
            words = WORD.findall(lower)
            left, right = WORD.findall(head)[-WINDOW:], WORD.findall(tail)[:WINDOW]
            self.weigh([words])
            weights = list(map(self.weight.__getitem__, words))
            total += len(words)
            if any(weights):
                found = self.matches(lower, words, weights, 0, len(words))
                for n, i in enumerate(i for i, w in enumerate(weights) if w):
                    found[n].window = [*left, *words, *right][max(0, i + len(left) - WINDOW) : i + len(left)] + [*words, *right][i + 1 : i + 1 + WINDOW]
                matches += found
            at = after
        return total, matches

    def matches(self, text: str, words: list[str], weights: list[float], start: int, stop: int) -> list[Match]:
        out = []
        for i, place in enumerate(WORD.finditer(text)):
            if weights[i]:
                window = words[max(0, i - WINDOW) : i] + words[i + 1 : i + 1 + WINDOW]
                out.append(Match(words[i], self.near.get(words[i]), weights[i], is_quoted(text, place.start(), place.end()), window))
        return out

    def features(self, words: int, matches: list[Match]) -> list[float]:
        """How much abuse, the strongest, how many different words, how dense; how many quoted; how long."""
        abuse = [m.weight / (1 + np.exp(-2 - self.context(m))) for m in matches]
        total = float(sum(abuse))
        distinct = len({m.word for m, a in zip(matches, abuse, strict=True) if a > 0.5})
        quoted = sum(m.quoted for m in matches)
        return [np.log1p(total), max(abuse, default=0.0), np.log1p(distinct), np.log1p(100 * total / max(words, 20)), np.log1p(quoted), np.log1p(words)]

    def context(self, match: Match) -> float:
        odds = [self.lexicon.context[bucket(w)] for w in match.window]
        return float(np.clip(2 * sum(odds) / max(1, len(odds)), -3, 3)) + (self.lexicon.quoted if match.quoted else 0.0)


def bucket(word: str) -> int:
    return zlib.crc32(word.encode()) % BUCKETS


def is_quoted(text: str, start: int, end: int) -> bool:
    """Marks at the word itself, or an open double quotation around it in its line."""
    if text[max(0, start - 1) : start] in QUOTES and start or text[end : end + 1] in QUOTES and end < len(text):
        return True
    left = text[max(0, start - 120) : start].rpartition("\n")[2]
    right = text[end : end + 120].partition("\n")[0]
    return left.count('"') % 2 == 1 and '"' in right or left.count("“") > left.count("”") or left.count("«") > left.count("»")


# Learning


def gain(toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> np.ndarray:
    """Log-likelihood ratio of documents with a term against the share of toxic documents."""
    both, share = np.maximum(toxic + clean, 1), n_toxic / max(1, n_toxic + n_clean)
    parts = [n * np.log(np.maximum(n, 1e-9) / (both * max(s, 1e-9))) for n, s in ((toxic, share), (clean, 1 - share))]
    return 2 * (parts[0] + parts[1])


def log_odds(toxic, clean, n_toxic: int, n_clean: int):
    return np.log((toxic + 0.5) / (n_toxic + 1)) - np.log((clean + 0.5) / (n_clean + 1))


def choose(candidates: list[str], toxic: np.ndarray, clean: np.ndarray, n_toxic: int, n_clean: int) -> Lexicon:
    """The most telling candidates of which none begins another; of equal ones the longest."""
    score, odds = gain(toxic, clean, n_toxic, n_clean), log_odds(toxic, clean, n_toxic, n_clean)
    fit = np.flatnonzero((toxic >= LEAST_DOCUMENTS) & (score >= LEAST_GAIN) & (odds >= LEAST_ODDS))
    terms, weights, starts = [], [], set()
    for i in sorted(fit.tolist(), key=lambda i: (-score[i], -len(candidates[i]), candidates[i])):
        term = candidates[i]
        begun = [term[:k] for k in range(1, len(term) + 1)]
        if term in starts or any(b in terms for b in begun):
            continue
        terms.append(term)
        weights.append(float(min(odds[i], 8.0)))
        starts.update(begun)
        if len(terms) == TERMS:
            break
    return Lexicon(terms, weights)


def starts_of(word: str) -> list[str]:
    """The terms a word speaks for: its stems, and itself."""
    whole = [word + END] if min(STEM_LENGTHS) <= len(word) <= LONGEST else []
    return [word[:k] for k in STEM_LENGTHS if k <= len(word)] + whole


def sketch(text: str) -> list[int]:
    """Three least hashes of five-word shingles: near copies share one of them almost surely."""
    words = WORD.findall(text.lower())
    shingles = [zlib.crc32(" ".join(words[i : i + 5]).encode()) for i in range(max(1, len(words) - 4))]
    values = np.array(shingles, np.uint64)
    return [int((values * np.uint64(m) % np.uint64(4294967291)).min()) for m in (2654435761, 1597334677, 3812015801)]


def training_rows(documents: DataFrame, labels: DataFrame, train_rows: int) -> DataFrame:
    """doc_id, toxic, half, text of labelled documents; of near copies only the smallest id. A written table."""
    marked = labels.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("toxic").cast("int").alias("toxic"))
    marked = marked.where("doc_id is not null and toxic in (0, 1)").groupBy("doc_id").agg(F.min("toxic").alias("toxic"))
    sample = F.broadcast(sample_of(marked, train_rows, "doc_id"))  # at most train_rows rows of 12 bytes

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            sketches = [sketch(t) for t in batch.column("text").to_pylist()]
            yield pa.record_batch([*batch.columns, pa.array(sketches, pa.list_(pa.int64()))], names=[*batch.schema.names, "sketch"])

    half = F.pmod(F.xxhash64("doc_id"), F.lit(2)).cast("int").alias("half")
    rows = text_frame(documents).join(sample, "doc_id").select("doc_id", "toxic", half, "text")
    rows = kept(mapped(rows, add, "doc_id long, toxic int, half int, text string, sketch array<long>"))
    met: set[tuple[int, int]] = set()
    first = []
    for r in sorted(rows.select("doc_id", "sketch").collect(), key=lambda r: r["doc_id"]):  # at most train_rows ids
        marks = set(enumerate(r["sketch"]))
        if not marks & met:
            first.append((r["doc_id"],))
        met |= marks
    alone = documents.sparkSession.createDataFrame(first, "doc_id long") if first else rows.select("doc_id").limit(0)
    return kept(rows.drop("sketch").join(F.broadcast(alone), "doc_id"))


def counted(rows: DataFrame) -> tuple[list[str], dict[str, np.ndarray]]:
    """Candidate terms, and for "toxic" and "clean" how many documents of either half hold each."""

    def starts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: dict[str, int] = {}
        for batch in slices(batches):
            for text in batch.column("text").to_pylist():
                for start in {s for w in set(WORD.findall(text.lower())) for s in starts_of(w)}:
                    counts[start] = counts.get(start, 0) + 1
        yield pa.record_batch([pa.array(list(counts), pa.string()), pa.array(list(counts.values()), pa.int64())], names=["term", "n"])

    toxic = mapped(rows.where("toxic = 1").select("text"), starts, "term string, n long").groupBy("term").agg(F.sum("n").alias("n"))
    frequent = toxic.where(F.col("n") >= LEAST_DOCUMENTS).orderBy(F.desc("n"), "term").limit(CANDIDATES)
    candidates = sorted(r["term"] for r in frequent.collect())
    shared = rows.sparkSession.sparkContext.broadcast({c: i for i, c in enumerate(candidates)})

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        index, of_word = shared.value, {}
        total = np.zeros((4, len(index)), np.int64)
        for batch in slices(batches):
            for text, label, half in zip(*(batch.column(c).to_pylist() for c in ("text", "toxic", "half")), strict=True):
                here = set()
                for word in set(WORD.findall(text.lower())):
                    if word not in of_word:
                        of_word[word] = tuple(index[s] for s in starts_of(word) if s in index)
                    here.update(of_word[word])
                total[label * 2 + half, list(here)] += 1
        kind, term = total.nonzero()
        yield pa.record_batch([pa.array(kind, pa.int32()), pa.array(term, pa.int32()), pa.array(total[kind, term])], names=["kind", "term", "n"])

    out = np.zeros((4, len(candidates)), np.int64)
    sums = mapped(rows, count, "kind int, term int, n long").groupBy("kind", "term").agg(F.sum("n").alias("n"))
    for r in sums.collect():  # four numbers a candidate
        out[r["kind"], r["term"]] = r["n"]
    return candidates, {"clean": out[:2], "toxic": out[2:]}


def with_surroundings(rows: DataFrame, lexicons: list[Lexicon], sizes: list[tuple[int, int]]) -> None:
    """Learns what stands around matches, and words near a term that clean documents hold. Lexicon 2 is of both halves."""
    shared = rows.sparkSession.sparkContext.broadcast([vars(x) for x in lexicons])

    def look(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = [Reader(Lexicon(**x)) for x in shared.value]
        counts: dict[tuple[int, str, int], int] = {}
        for batch in slices(batches):
            texts, labels, halves = (batch.column(c).to_pylist() for c in ("text", "toxic", "half"))
            for which, reader in enumerate(readers):
                some = [i for i, h in enumerate(halves) if which in (h, 2)]
                for i, (_, matches) in zip(some, reader.read([texts[i] for i in some]), strict=True):
                    for m in matches:
                        for key in [f"b{bucket(w)}" for w in m.window] + ["q1" if m.quoted else "q0"]:
                            counts[which, key, labels[i]] = counts.get((which, key, labels[i]), 0) + 1
                    for key in {f"w{m.near} {m.word}" for m in matches if m.near is not None}:
                        counts[which, key, labels[i]] = counts.get((which, key, labels[i]), 0) + 1
        keys = list(counts)
        yield pa.record_batch(
            [pa.array([k[0] for k in keys], pa.int32()), pa.array([k[1] for k in keys], pa.string()), pa.array([k[2] for k in keys], pa.int32()), pa.array(list(counts.values()), pa.int64())],
            names=["which", "thing", "toxic", "n"],
        )

    found = mapped(rows, look, "which int, thing string, toxic int, n long").groupBy("which", "thing").agg(
        F.sum(F.expr("if(toxic = 1, n, 0)")).alias("toxic"), F.sum(F.expr("if(toxic = 0, n, 0)")).alias("clean")
    )
    things: list[dict[str, tuple[int, int]]] = [{}, {}, {}]
    for r in found.collect():  # window buckets, and the few words near a term, of the training rows
        things[r["which"]][r["thing"]] = (r["toxic"], r["clean"])
    for lexicon, thing, (n_toxic, n_clean) in zip(lexicons, things, sizes, strict=True):
        total = np.sum([thing.get(q, (0, 0)) for q in ("q0", "q1")], axis=0)
        share = np.clip(total[0] / max(1, total.sum()), 0.01, 0.99)

        def shrunk(toxic: int, clean: int, share: float = share) -> float:
            return float(np.log((toxic + SHRINK * share) / (clean + SHRINK * (1 - share))) - np.log(share / (1 - share)))

        innocent: dict[int, int] = {}
        lexicon.quoted = QUOTED_PRIOR + shrunk(*thing.get("q1", (0, 0)))
        for key, (toxic, clean) in thing.items():
            if key[0] == "b":
                lexicon.context[int(key[1:])] = shrunk(toxic, clean)
            elif key[0] == "w" and clean:
                term, word = key[1:].split(" ")
                lexicon.known[word] = float(max(0.0, log_odds(toxic, clean, n_toxic, n_clean)))
                innocent[int(term)] = innocent.get(int(term), 0) + 1
        # Where many different clean words are near a term, the next one is likely clean too.
        lexicon.trust = {term: 2 / (2 + n) for term, n in innocent.items()}


@dataclass
class Model:
    lexicon: Lexicon
    mean: np.ndarray
    scale: np.ndarray
    weights: np.ndarray  # the last one stands alone

    def scores(self, features: np.ndarray) -> np.ndarray:
        x = np.column_stack(((features - self.mean) / self.scale, np.ones(len(features))))
        return 1 / (1 + np.exp(-np.clip(x @ self.weights, -30, 30)))


def fit(lexicon: Lexicon, x: np.ndarray, y: np.ndarray) -> Model:
    """Logistic regression by Newton's steps, weights held near zero. Without both labels, the share of ones."""
    width = x.shape[1]
    if not len(y) or y.min() == y.max():
        share = (y.sum() + 0.5) / (len(y) + 1) if len(y) else 0.1
        return Model(lexicon, np.zeros(width), np.ones(width), np.append(np.zeros(width), np.log(share / (1 - share))))
    mean, scale = x.mean(axis=0), x.std(axis=0) + 1e-3
    rows = np.column_stack(((x - mean) / scale, np.ones(len(x))))
    weights, ridge = np.zeros(width + 1), np.append(np.full(width, 0.1), 1e-6)
    for _ in range(50):
        p = 1 / (1 + np.exp(-np.clip(rows @ weights, -30, 30)))
        slope = rows.T @ (p - y) + ridge * weights
        bend = (rows * (p * (1 - p) + 1e-9)[:, None]).T @ rows + np.diag(ridge)
        step = np.linalg.solve(bend, slope)
        weights = weights - step * min(1.0, 4.0 / max(1e-9, np.abs(step).max()))
        if np.abs(step).max() < 1e-8:
            break
    return Model(lexicon, mean, scale, weights)


def train(documents: DataFrame, labels: DataFrame, train_rows: int = TRAIN_ROWS) -> Model:
    """From at most train_rows labelled documents: `labels` has doc_id and toxic (0 or 1), other values play no part."""
    rows = training_rows(documents, labels, train_rows)
    sizes = np.zeros((2, 2), np.int64)
    for r in rows.groupBy("half", "toxic").count().collect():
        sizes[r["half"], r["toxic"]] = r["count"]
    candidates, found = counted(rows)
    lexicons, totals = [], []
    for halves in ([0], [1], [0, 1]):
        n_clean, n_toxic = sizes[halves].sum(axis=0).tolist()
        lexicons.append(choose(candidates, found["toxic"][halves].sum(axis=0), found["clean"][halves].sum(axis=0), n_toxic, n_clean))
        totals.append((n_toxic, n_clean))
    with_surroundings(rows, lexicons, totals)
    shared = rows.sparkSession.sparkContext.broadcast([vars(x) for x in lexicons[:2]])

    def features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        readers = [Reader(Lexicon(**x)) for x in shared.value]
        for batch in slices(batches):
            texts, halves = batch.column("text").to_pylist(), batch.column("half").to_pylist()
            values: list = [None] * len(texts)
            for half, reader in enumerate(readers):
                others = [i for i, h in enumerate(halves) if h != half]
                for i, found in zip(others, reader.read([texts[i] for i in others]), strict=True):
                    values[i] = [float(v) for v in reader.features(*found)]
            yield pa.record_batch([batch.column("doc_id"), batch.column("toxic"), pa.array(values, pa.list_(pa.float64()))], names=["doc_id", "toxic", "features"])

    fitted = mapped(rows, features, "doc_id long, toxic int, features array<double>").collect()  # at most train_rows rows
    fitted.sort(key=lambda r: (r["doc_id"], r["features"]))
    x = np.array([r["features"] for r in fitted], np.float64).reshape(len(fitted), 6)
    return fit(lexicons[2], x, np.array([r["toxic"] for r in fitted], np.float64))


def score(documents: DataFrame, model: Model, threshold: float = 0.3) -> DataFrame:
    """doc_id, score (0 to 1), predicted (1 from the threshold on), n_matches, terms (distinct matched words in order).

    Null and empty texts have no words and are scored as such. Repeated rows are scored each; rows without a
    doc_id are left out; columns besides the text play no part; an empty table gives an empty one.
    """
    shared = documents.sparkSession.sparkContext.broadcast(vars(model) | {"lexicon": vars(model.lexicon)})  # of a fixed size

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Model(**shared.value | {"lexicon": Lexicon(**shared.value["lexicon"])})
        reader = Reader(model.lexicon)
        for batch in slices(batches):
            found = list(reader.read(batch.column("text").to_pylist()))
            p = model.scores(np.array([reader.features(*x) for x in found], np.float64).reshape(len(found), 6))
            words = [sorted({m.word for m in matches}) for _, matches in found]
            yield pa.record_batch(
                [batch.column("doc_id"), pa.array(p), pa.array((p >= threshold).astype(np.int32)), pa.array([len(m) for _, m in found], pa.int64()), pa.array(words, pa.list_(pa.string()))],
                names=["doc_id", "score", "predicted", "n_matches", "terms"],
            )

    return mapped(text_frame(documents), run, "doc_id long, score double, predicted int, n_matches long, terms array<string>")


def held_out(remainder: int = 2, modulus: int = 4):
    """Documents whose labels are never learnt from, by the CRC of the id's digits."""
    return F.crc32(F.col("doc_id").cast("string").cast("binary")) % modulus == remainder


def score_held_out(documents: DataFrame, labels: DataFrame) -> DataFrame:
    """Every document scored by a model fitted on labels of those that aren't held out."""
    return score(documents, train(documents, labels.where(~held_out()))).withColumn("held_out", held_out())
