"""Toxicity: automata against plain edit distance, matches in whole texts, learning on planted documents, odd tables."""

import random

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from pitlake.llm import abuse_terms
from pitlake.llm.abuse_terms import END, Automaton, Lexicon, Reader

SCHEMA = "doc_id long, text string, toxic int, half int, sketch string, score string"
INSULTS = ["grobnik", "felchan", "wortmolder", "tuskin"]


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, before = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, before[j] + 1, before[j - 1] + (x != y)))
    return row[-1]


def brute(terms, word):
    """Fewest errors of a whole word that allows as many, or 0 if the word begins with a stem; None: no match."""
    found = [0 for t in terms if not t.endswith(END) and word.startswith(t)]
    for term in terms:
        if term.endswith(END):
            d = distance(term[:-1], word)
            if d <= abuse_terms.errors_allowed(term):
                found.append(d)
    return min(found, default=None)


@settings(max_examples=200, deadline=None)
@given(
    st.lists(st.tuples(st.text("abcé", min_size=4, max_size=9), st.booleans()), max_size=5),
    st.lists(st.text("abcéx", max_size=12), min_size=1, max_size=20),
)
def test_automaton_finds_what_plain_distance_finds(terms, words):
    terms = list(dict.fromkeys(t if stem else t + END for t, stem in terms))
    automaton = Automaton(terms)
    term, errors = automaton.match(words)
    for word, t, e in zip(words, term.tolist(), errors.tolist(), strict=True):
        assert (None if t < 0 else e) == brute(terms, word)
        if t >= 0 and terms[t].endswith(END):
            assert distance(terms[t][:-1], word) == e
        elif t >= 0:
            assert word.startswith(terms[t])


def test_states_start_over(monkeypatch):
    monkeypatch.setattr(abuse_terms, "STATES", 3)
    automaton = Automaton(["grobnik" + END])
    for word, errors in (("grobnik", 0), ("grobnk", 1), ("grubnik", 1), ("groobnik", 1), ("gruubnik", None)):
        term, found = automaton.match([word])
        assert (int(found[0]) if term[0] >= 0 else None) == errors


def reader():
    return Reader(Lexicon(["grobnik" + END, "tusk"], [5.0, 3.0]))


def words_of(matches):
    return [m.word for m in matches]


def test_matches_in_a_text():
    text = 'A Grobnik!!! and a gr*bnik, grobnk. "grobnik" he wrote; tuskers, atusk; say grobnik@tuskin'
    ((n, found),) = reader().read([text])
    assert words_of(found) == ["grobnik", "gr*bnik", "grobnk", "grobnik", "tuskers", "grobnik@tuskin"]
    assert [m.quoted for m in found] == [False, False, False, True, False, False]
    assert n == len(abuse_terms.WORD.findall(text))
    assert list(reader().read([])) == [] and list(reader().read(["", "  "])) == [(0, []), (0, [])]


def test_a_long_text_in_parts_reads_as_a_whole(monkeypatch):
    rng = random.Random(3)
    text = " ".join(rng.choice(["grobnik", "grobnk", "some", "other", "words", "tuskers", "and", "more\n"]) for _ in range(4000))
    ((n, whole),) = reader().read([text])
    monkeypatch.setattr(abuse_terms, "PART", 300)
    ((m, parts),) = reader().read([text])
    assert n == m and [(x.word, x.weight, x.window) for x in whole] == [(x.word, x.weight, x.window) for x in parts]


def planted(n, seed, misspell=False):
    """(id, text, toxic): of six texts two insult, one quotes the insults, three do neither."""
    rng = random.Random(seed)
    syllables = ["ba", "do", "ki", "lu", "me", "ra", "so", "ti", "vu", "ze"]

    def prose(k):
        return ["".join(rng.choice(syllables) for _ in range(rng.randint(1, 4))) for _ in range(k)]

    rows = []
    for i in range(n):
        kind, words = i % 6, prose(rng.randint(30, 90))
        for _ in range(3):
            insult = rng.choice(INSULTS)
            if misspell:
                at = rng.randrange(1, len(insult) - 1)
                insult = insult[:at] + rng.choice(["", "0", insult[at] * 2]) + insult[at + 1 :]
            at = rng.randrange(len(words))
            if kind < 2:
                words[at:at] = [insult]
            elif kind == 2:
                words[at:at] = ["domeki", f'"{insult}"', "tizelu"]
        rows.append((seed * 100_000 + i, " ".join(words), int(kind < 2)))
    return rows


def frame(spark, rows):
    return spark.createDataFrame([(i, t, 9, 8, "clash", "clash") for i, t, *_ in rows], SCHEMA)


def labels_of(spark, rows):
    return spark.createDataFrame([(i, y) for i, _, y in rows], "doc_id long, toxic int")


@pytest.fixture(scope="module")
def model(spark):
    rows = planted(600, 1)
    return abuse_terms.train(frame(spark, rows), labels_of(spark, rows))


def test_learns_the_insults(model):
    assert {t.rstrip(END)[:4] for t in model.lexicon.terms} >= {x[:4] for x in INSULTS}


@pytest.mark.parametrize("misspell", [False, True], ids=["as learnt", "misspelled"])
def test_tells_abuse_from_quotation(spark, model, misspell):
    rows = planted(240, 2, misspell)
    found = {r.doc_id: r.predicted for r in abuse_terms.score(frame(spark, rows), model).collect()}
    caught = sum(found[i] for i, _, y in rows if y) / 80
    wrong = sum(found[i] for i, _, y in rows if not y) / 160
    assert caught >= 0.9 and wrong <= 0.05


def test_odd_rows(spark, model):
    rows = [(1, None), (2, ""), (3, "grobnik " * 5), (3, "grobnik " * 5), (4, "plain words " * 20_000), (None, "no id"), (5, "x" * 100_000)]
    found = sorted((r.doc_id, r.predicted, r.n_matches) for r in abuse_terms.score(frame(spark, rows), model).collect())
    assert found == [(1, 0, 0), (2, 0, 0), (3, 1, 5), (3, 1, 5), (4, 0, 0), (5, 0, 0)]
    assert all(0 <= r.score <= 1 for r in abuse_terms.score(frame(spark, rows), model).collect())
    assert abuse_terms.score(frame(spark, []), model).collect() == []


@pytest.mark.parametrize("toxic", [None, 0, 1], ids=["no labels", "all clean", "all toxic"])
def test_without_both_labels(spark, toxic):
    rows = [] if toxic is None else [(i, f"some text number {i}", toxic) for i in range(6)]
    fitted = abuse_terms.train(frame(spark, rows), labels_of(spark, rows))
    found = abuse_terms.score(frame(spark, [(1, "any text"), (2, None)]), fitted).collect()
    assert [r.predicted for r in found] == [int(toxic == 1)] * 2


def test_held_out_labels_of_the_test_data(spark):
    sf = "/root/testdata/sf0.01"
    labels = {r.doc_id: r.toxic for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    scored = abuse_terms.score_held_out(spark.read.parquet(f"{sf}/documents.parquet"), spark.read.parquet(f"{sf}/labels.parquet"))
    found = [r for r in scored.collect() if r.held_out and r.doc_id in labels]
    assert sum(r.predicted == labels[r.doc_id] for r in found) >= 0.9 * len(found)
