"""Each operator against a plain version on odd little tables: nulls, empty and long texts, ties, repeats, extra columns."""

import collections
import hashlib
import heapq
import re
import time
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from pitlake.llm import byte_bpe, content_sort, kneser_ney, ngram_join, perspectives, quality, sharding, suffix_dedup, suffix_search
from pitlake.llm.common import FREED, kept
from pitlake.llm.components import components

SCHEMA = "doc_id long, text string, lang string, digest string, label int"
LONG = " ".join(f"word{i % 977}x{i % 31}" for i in range(30_000))
PASSAGE = "a passage of some length that several documents hold word for word, with ünïcödé in it and more"
TEXTS = [
    (1, PASSAGE), (2, None), (3, ""), (4, LONG), (5, PASSAGE.upper()), (6, "before it " + PASSAGE + " and after"),
    (7, " \t\n "), (8, "one two"), (9, "one two"), (10, "ONE two"), (11, LONG + " tail"), (12, "x" * 300), (13, "y" + "x" * 299),
    (14, "Ha Ha Ha Ha Ha Ha Ha Ha Ha Ha Ha Ha Ha Ha Ha Ha Ha Ha Ha Ha"), (15, PASSAGE[:60] + " quite another end " + PASSAGE[40:]),
]


def fold(text):
    return (text or "").translate({c: c + 32 for c in range(65, 91)})


def frame(spark, rows=TEXTS):
    return spark.createDataFrame([(i, t, "en", "clash", 0) for i, t in rows], SCHEMA)


def rows_of(df, *names):
    return sorted(tuple(r[n] for n in names) for r in df.collect())


@pytest.fixture(params=["odd", "empty"])
def documents(spark, request):
    return frame(spark, TEXTS if request.param == "odd" else [])


def texts_of(documents):
    return sorted((r.doc_id, r.text or "") for r in documents.collect() if r.doc_id is not None)


@pytest.mark.parametrize("keep", ["smallest", "largest"])
def test_exact_duplicates(spark, documents, keep):
    groups = collections.defaultdict(list)
    for i, text in texts_of(documents):
        groups[fold(text)].append(i)
    pick = min if keep == "smallest" else max
    expected = sorted(
        (i, pick(ids), len(ids), i == pick(ids), hashlib.sha256(text.encode()).hexdigest()) for text, ids in groups.items() for i in ids
    )
    found = content_sort.exact_duplicates(documents, keep, 3)
    assert rows_of(found, "doc_id", "keep_id", "group_size", "kept", "text_sha256") == expected


def test_rows_without_an_id_are_left_out(spark):
    rows = frame(spark, [(None, "some text"), (1, "some text"), (1, "some text")])
    assert rows_of(content_sort.exact_duplicates(rows), "doc_id", "keep_id", "group_size") == [(1, 1, 2), (1, 1, 2)]


def brute_components(texts):
    sets = {}
    for i, text in texts:
        words = re.findall(r"[^\x20\x09-\x0D]+", fold(text))
        sets[i] = {tuple(words[k : k + 5]) for k in range(len(words) - 4)} if len(words) >= 5 else ({tuple(words)} if words else set())
    label = {i: i for i in sets}
    changed = True
    while changed:
        changed = False
        for a in sets:
            for b in sets:
                common = len(sets[a] & sets[b])
                if a < b and sets[a] and sets[b] and 100 * common >= 80 * len(sets[a] | sets[b]) and label[a] != label[b]:
                    low, high = sorted((label[a], label[b]))
                    label = {i: low if x == high else x for i, x in label.items()}
                    changed = True
    return sorted((i, len(sets[i]), label[i]) for i in sets)


def test_jaccard_groups(spark, documents):
    found = ngram_join.jaccard_groups(documents)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == brute_components(texts_of(documents))


def test_jaccard_chains_and_neighbours_of_a_common_passage(spark):
    base = [f"w{i}" for i in range(60)]
    rows = [(100 - k, " ".join(base[:k] + [f"new{k}_{j}" for j in range(4)] + base[k:])) for k in range(0, 60, 3)]
    rows += [(200 + k, " ".join(base[k:] + [f"other{j}" for j in range(k)])) for k in range(12)]
    rows += [(300 + k, " ".join(base) + f" end{k}") for k in range(40)] + [(400, rows[3][1]), (5, rows[7][1])]
    found = ngram_join.jaccard_groups(frame(spark, rows))
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == brute_components(rows)


def test_pairs_that_share_many_columns_meet_once_and_none_is_lost(spark, monkeypatch):
    base = [f"w{i}" for i in range(60)]
    rows = [(i, " ".join([f"group{i % 3}_{w}" for w in base[:52]] + [f"own{i}_{j}" for j in range(8)])) for i in range(42)]
    rows += [(100, rows[5][1] + " tail"), (101, rows[5][1] + " other")]
    met, of_reps = [], ngram_join.of_reps

    def seen(pairs, rep_of):
        met.append([(r.a, r.b) for r in pairs.collect()])
        return of_reps(pairs, rep_of)

    monkeypatch.setattr(ngram_join, "of_reps", seen)
    found = ngram_join.jaccard_groups(frame(spark, rows))
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == brute_components(rows)
    monkeypatch.setattr(ngram_join, "EARLY", 0)
    ngram_join.jaccard_groups(frame(spark, rows))
    last, every = met[2], met[5]
    assert {tuple(sorted(x)) for x in last} == {tuple(sorted(x)) for x in every}
    assert 3 * len(last) < len(every)
    assert len(last) <= 1.1 * len({tuple(sorted(x)) for x in last})


def test_frequent_columns_take_the_split_path(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HEAVY_FROM", 2)
    base = [f"w{i}" for i in range(50)]
    rows = [(i, " ".join([*base[: 20 + i % 7], f"x{i}", *base[20 + i % 7 :]])) for i in range(30)]
    found = ngram_join.jaccard_groups(frame(spark, rows))
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == brute_components(rows)


def test_texts_become_entries_once(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "HEAVY_FROM", 2)
    read, incidence = spark.sparkContext.accumulator(0), ngram_join.incidence

    def counted(docs, *more):
        def count(batches):
            for batch in batches:
                read.add(batch.num_rows)
                yield batch

        return incidence(docs.mapInArrow(count, docs.schema), *more)

    monkeypatch.setattr(ngram_join, "incidence", counted)
    rows = [(i, f"a b c d e f g h i j k l m n o p q r s t u v w x{i}") for i in range(6)] + [(9, "some other words"), (10, None)]
    found = ngram_join.jaccard_groups(frame(spark, rows))
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == brute_components(rows)
    assert read.value == len(rows)


def test_hashed_sets_are_distinct_and_sorted():
    for values in ([], [7], [3, 3], [5, 1, 5, 2, 1], [2, 1]):
        assert ngram_join.distinct(np.array(values, np.uint64)).tolist() == sorted(set(values))


def test_shuffles_of_kept_rows_leave_the_disk(spark):
    disk, before = spark._jvm.org.apache.spark.SparkEnv.get().blockManager().diskBlockManager(), spark.conf.get(FREED)

    def shuffles():
        return {x for x in disk.getAllFiles().mkString("\n").split("\n") if "/shuffle_" in x}

    there = shuffles()
    found = kept(spark.range(5000).repartition(3, "id").groupBy((F.col("id") % 7).alias("k")).count())
    end = time.monotonic() + 20
    while shuffles() - there and time.monotonic() < end:
        time.sleep(0.2)
    assert not shuffles() - there
    assert spark.conf.get(FREED) == before
    assert found.count() == 7


@pytest.mark.parametrize("tile", [256, 3])
def test_all_links_between_distinct_sets(spark, monkeypatch, tile):
    """Also those between texts that one component holds already: A-B, A-C and B-C."""
    monkeypatch.setattr(ngram_join, "TILE", tile)
    base = [f"w{i}" for i in range(60)]
    rows = [(1, " ".join([*base, "a"])), (2, " ".join([*base, "b"])), (3, " ".join([*base, "c"])), (4, " ".join([*base, "c"])), (5, None)]
    rows += [(10 + k, " ".join(["x"] + base[3 * k :] + [f"y{k}_{j}" for j in range(3 * k)])) for k in range(12)]
    rows += [(40 + k, " ".join([f"z{i}" for i in range(30)] + [f"end{k % 4}"])) for k in range(9)] + [(60, "one two"), (61, "ONE two")]
    sets = {}
    for i, text in rows:
        words = (text or "").lower().split()
        sets.setdefault(frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4)) if words), []).append(i)
    sets.pop(frozenset())
    linked = [(x, y) for x in sets for y in sets if x != y and 100 * len(x & y) >= 80 * len(x | y)]
    assert rows_of(ngram_join.jaccard_links(frame(spark, rows)), "a", "b") == sorted((sets[x][0], sets[y][0]) for x, y in linked if sets[x][0] < sets[y][0])
    degrees = {i: sum(a == x for a, _ in linked) for x in sets for i in sets[x]}
    found = ngram_join.jaccard_join(frame(spark, rows))
    assert rows_of(found, "doc_id", "n_links") == sorted((i, degrees.get(i, 0)) for i, _ in rows)
    assert rows_of(found, "doc_id", "n_shingles", "component_id") == brute_components(rows)


def test_components_of_a_long_chain(spark):
    links = spark.createDataFrame([(i, i + 1) for i in range(300)] + [(1000, 1000), (2000, 1500)], "a long, b long")
    found = dict(rows_of(components(links), "node", "label"))
    assert found == {**{i: 0 for i in range(301)}, 2000: 1500, 1500: 1500}


def brute_spans(texts, window=50):
    first, out = {}, []
    for i, text in texts:
        data = text.encode()
        covered = np.zeros(len(data), np.bool_)
        for p in range(len(data) - window + 1):
            if first.setdefault(data[p : p + window], i) < i:
                covered[p : p + window] = True
        kept = bytes(np.frombuffer(data, np.uint8)[~covered])
        spans = int((np.diff(np.concatenate(([0], covered.astype(int)))) == 1).sum())
        out.append((i, len(data), int(covered.sum()), spans, hashlib.sha256(kept).hexdigest()))
    return out


SPAN_FIELDS = ("doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256")


def test_remove_repeats(spark, documents):
    assert rows_of(suffix_dedup.remove_repeats(documents), *SPAN_FIELDS) == brute_spans(texts_of(documents))


@pytest.mark.parametrize("group_rows", [50_000, 3])
def test_repeats_at_all_offsets(spark, monkeypatch, group_rows):
    """Windows that share a gram but not all around it; few rows a group send them by shuffled windows."""
    monkeypatch.setattr(suffix_dedup, "GROUP_ROWS", group_rows)
    rng = np.random.default_rng(5)
    letters = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    common = letters(400)
    rows = []
    for i in range(60):
        a = int(rng.integers(0, 330))
        n = int(rng.integers(45, 70))
        rows.append((int(i * 7 % 60), letters(int(rng.integers(0, 40))) + common[a : a + n] + letters(int(rng.integers(0, 40)))))
    rows += [(100, "ab" * 60), (101, "ba" * 60), (102, "é" * 40)]
    rows.sort()
    assert rows_of(suffix_dedup.remove_repeats(frame(spark, rows)), *SPAN_FIELDS) == brute_spans(rows)


@pytest.mark.parametrize("group_rows", [50_000, 3])
def test_a_passage_that_stands_twice_in_one_document(spark, monkeypatch, group_rows):
    """Its surroundings are the same at both places, and others than in the smaller document."""
    monkeypatch.setattr(suffix_dedup, "GROUP_ROWS", group_rows)
    rng = np.random.default_rng(6)
    letters = lambda n: "".join(rng.choice(list("abcdefgh"), n))
    rows = []
    for i in range(0, 40, 4):
        passage, x, y = letters(60), letters(45), letters(45)
        rows += [(i, letters(45) + passage + letters(45)), (i + 1, (x + passage + y) * 2), (i + 2, (y + passage + x) * 3 + letters(9))]
        rows += [(i + 3, passage[5:] + letters(50) + passage[:57])]
    rows += [(100, "q" * 49 + "é" + "z" * 60), (101, "p" + "z" * 55 + "p" + letters(90) + "z" * 400), (102, "ab" * 30 + "c"), (103, "d" + "ab" * 90)]
    assert rows_of(suffix_dedup.remove_repeats(frame(spark, rows)), *SPAN_FIELDS) == brute_spans(rows)


def brute_hits(texts, items, window=10):
    pattern = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"
    out = []
    for i, text in texts:
        words = re.findall(pattern, fold(text))
        hit, matched = set(), set()
        for item, body in items:
            own = re.findall(pattern, fold(body))
            n = min(window, len(own))
            for a in range(len(own) - n + 1) if n else ():
                for p in range(len(words) - n + 1):
                    if words[p : p + n] == own[a : a + n]:
                        hit.update(range(p, p + n))
                        matched.add(str(item))
        out.append((i, len(words), len(hit), len(matched), hashlib.sha256(",".join(sorted(matched)).encode()).hexdigest()))
    return out


@pytest.mark.parametrize("block_words", [2_000_000, 12])
def test_find_benchmark(spark, documents, block_words):
    texts = texts_of(documents)
    items = [(1, PASSAGE + "!"), (2, "one, TWO"), (10, None), (11, ""), (3, "Ha ha ha"), (9, "some length that several documents hold word for word with x")]
    benchmark = spark.createDataFrame([(i, t, "clash") for i, t in items], "item_id long, text string, doc_id string")
    found = suffix_search.find_benchmark(documents, benchmark, block_words=block_words)
    n_items, digest = suffix_search.digest_of_items()
    found = found.select("doc_id", "n_words", "n_hit", n_items.alias("n"), digest.alias("d"))
    short = [(i, t) for i, t in texts if len(t) < 10_000]
    assert [r for r in rows_of(found, "doc_id", "n_words", "n_hit", "n", "d") if r[0] in dict(short)] == brute_hits(short, items)
    left = {r.doc_id for r in suffix_search.decontaminate(documents, benchmark).collect()}
    assert left == {r[0] for r in rows_of(found, "doc_id", "n_hit") if not r[1]}


def test_longest_matches(spark):
    item = " ".join(f"t{i}" for i in range(30))
    docs = frame(spark, [(1, "lead in " + " ".join(f"t{i}" for i in range(4, 22)) + " out")])
    benchmark = spark.createDataFrame([(7, item)], "item_id long, text string")
    match = suffix_search.find_benchmark(docs, benchmark).first()["matches"]
    assert [tuple(m) for m in match] == [(7, 4, 2, 18)]


@pytest.fixture(scope="module")
def encoder():
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    with open(path, "rb") as file:
        return byte_bpe.Encoder(byte_bpe.Vocabulary(file.read()), public_tokenizers.PATTERN)


@pytest.fixture(scope="module")
def reference(encoder):
    import tiktoken

    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=dict(encoder.vocabulary.rank), special_tokens={})


@settings(max_examples=150, deadline=None)
@given(st.lists(st.text(st.sampled_from(list("abe'st .,!1\n\t éß日🙂\x1c")) | st.characters(codec="utf-8"), max_size=60), max_size=6))
def test_encoding_is_exact(encoder, reference, texts):
    for text, ids in zip(texts, encoder.encode(texts), strict=True):
        assert ids.tolist() == reference.encode_ordinary(text)
        assert byte_bpe.decode(encoder.vocabulary, ids) == text.encode()


def test_encoding_of_documents(spark, documents, reference):
    path = public_tokenizers.path("byte_bpe_multi_50k.tiktoken")
    expected = [(i, reference.encode_ordinary(t), t) for i, t in texts_of(documents)]
    found = byte_bpe.encode_documents(documents, path, public_tokenizers.PATTERN)
    assert rows_of(found, "doc_id", "n_tokens", "ids", "decoded") == [(i, len(ids), ids, t) for i, ids, t in expected]
    digests = byte_bpe.encoding_digests(documents, path, public_tokenizers.PATTERN)
    sha = lambda data: hashlib.sha256(data).hexdigest()
    assert rows_of(digests, "doc_id", "ids_sha256", "decoded_sha256") == [
        (i, sha(np.array(ids, "<u4").tobytes()), sha(t.encode())) for i, ids, t in expected
    ]


def test_shards(spark):
    rows = TEXTS + [(1000 + i, f"text {i % 90} " * (i % 90 % 13 + 1)) for i in range(400)] + [(5000, "text"), (5000, "text")]
    found = sharding.shard_documents(frame(spark, rows), 5, fineness=50, slot_buckets=3).collect()
    assert sorted(r.doc_id for r in found) == sorted(i for i, _ in rows)
    text = dict(rows)
    groups, load, slots = {}, collections.Counter(), collections.defaultdict(list)
    for r in found:
        body = (text[r.doc_id] or "").encode()
        assert r.size == len(body) + 8 and r.text_crc32 == zlib.crc32(body)
        assert groups.setdefault(body, r.shard) == r.shard
        load[r.shard] += r.size
        slots[r.shard].append(r.slot)
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # The two long texts are larger than a fair share; the other shards are near equal.
    small = sorted(load.values())[:3]
    assert small[-1] - small[0] <= 0.1 * small[-1]
    assert sharding.shard_documents(frame(spark, []), 5).count() == 0


def test_longest_processing_time_order():
    rng = np.random.default_rng(3)
    units = [(str(i), int(x)) for i, x in enumerate(rng.integers(1, 50, 40))]
    loads, placed = [0] * 4, {}
    for name, size in sorted(units, key=lambda u: (-u[1], u[0])):
        shard = loads.index(min(loads))
        placed[name] = shard
        loads[shard] += size
    assert sharding.longest_first(units, 4) == placed
    assert heapq.nlargest(1, loads)[0] <= sum(loads) / 4 * 4 / 3 + 50


def rendered(turns, seen_by):
    text, mask = "", []
    for speaker, said in turns:
        text += "<|im_start|>" + ("assistant" if speaker == seen_by else f"user name={speaker}") + "\n"
        if speaker == seen_by:
            mask.append((len(text), len(said) + 11))
        text += said + "<|im_end|>\n"
    return text, mask


def test_perspectives(spark):
    rows = [
        (1, 0, "ann", "hi"), (1, 1, "bob", "hello é🙂"), (1, 2, "cy", None), (1, 1, "bob", "hello é🙂"), (1, 3, None, ""), (1, None, "ann", "when?"),
        (None, 0, "solo", "x"), (2, 0, "ann", "q"), (2, 5, "ann", "r"), (2, -1, "bob", "early"),
    ]
    table = spark.createDataFrame([(*r, "clash") for r in rows], "conv_id long, turn long, role string, text string, perspective string")
    expected = []
    parts = collections.defaultdict(list)
    for conv, turn, role, text in rows:
        part = -1 if turn is None else turn // 3 - (turn < 0)
        parts[conv, part].append((turn if turn is not None else -99, role or "unknown", text or ""))
    for (conv, part), turns in parts.items():
        for person in {r[2] or "unknown" for r in rows if r[0] == conv}:
            text, mask = rendered([t[1:] for t in sorted(turns)], person)
            expected.append((str(conv), person, part, len(turns), len(mask), text, mask))
    found = perspectives.rotate(table, part_turns=3).collect()
    assert sorted((str(r.conv_id), r.perspective, r.part, r.n_turns, r.n_masked, r.text, [tuple(m) for m in r.mask]) for r in found) == sorted(expected)
    assert perspectives.rotate(table.limit(0)).count() == 0
    python = [line for line in perspectives.rotate(table)._jdf.queryExecution().toString().splitlines() if re.search("Python|Pandas|Arrow", line)]
    assert python == []


def brute_scores(texts, held):
    words = lambda text: re.findall(r"[^\x20\x09-\x0D]+", fold(text)) + [None]
    pairs, count = collections.Counter(), collections.Counter()
    for i, text in texts:
        if not held(i):
            before = 0
            for word in words(text):
                pairs[before, word] += 1
                count[word] += 1
                before = word
    total, kinds = sum(count.values()), len(count)
    followed = collections.Counter(word for _, word in pairs)
    after = collections.defaultdict(list)
    for (context, _), n in pairs.items():
        after[context].append(n)
    tally = lambda values: [sum(v == k for v in values) for k in (1, 2, 3, 4)]
    d2, d1 = kneser_ney.discounts(tally(pairs.values())), kneser_ney.discounts(tally(followed.values()))
    off = lambda n, d: 0 if not n else d[min(n, 3) - 1]
    rest = sum(off(n, d1) for n in followed.values()) / len(pairs)

    def single(word):
        return (followed[word] - off(followed[word], d1)) / len(pairs) + rest / (kinds + 1)

    out = {}
    for i, text in texts:
        before, score, base, known = 0, 0.0, 0.0, 0
        for word in words(text):
            p = single(word)
            if before in after:
                n, all_ = pairs[before, word], sum(after[before])
                p = (n - off(n, d2)) / all_ + sum(off(m, d2) for m in after[before]) / all_ * p
            score, base, known = score + np.log10(p), base + np.log10((count[word] + 0.5) / (total + 0.5 * (kinds + 1))), known + (count[word] > 0)
            before = word
        out[i] = (len(words(text)), known, total, base, score)
    return out


def test_language_model(spark):
    held = lambda i: zlib.crc32(str(i).encode()) % 5 == 1
    rows = TEXTS + [(100 + i, f"the cat {i % 5} sat on the {i % 3} mat") for i in range(60)]
    expected = brute_scores([(i, t or "") for i, t in rows], held)
    found = kneser_ney.score_held_out(frame(spark, rows)).collect()
    assert len(found) == len(rows)
    for r in found:
        assert r.held_out == held(r.doc_id)
        assert (r.n_tokens, r.n_known, r.train_tokens) == expected[r.doc_id][:3]
        np.testing.assert_allclose((r.base_score, r.score), expected[r.doc_id][3:], rtol=1e-9)
    empty = frame(spark, [])
    assert kneser_ney.score(empty, kneser_ney.train(empty)).count() == 0
    assert [r.score for r in kneser_ney.score(frame(spark, [(1, "a b")]), kneser_ney.train(empty)).collect()] == [0.0]


def test_probabilities_sum_to_one(spark):
    model = kneser_ney.train(frame(spark, [(i, f"a b {'c' if i % 2 else 'd'} a{i}") for i in range(9)]), shards=3)
    import pyarrow as pa

    vocabulary = ["a", "b", "c", "d", *(f"a{i}" for i in range(9))]
    _, token, _ = kneser_ney.tokens(pa.record_batch([pa.array([" ".join([*vocabulary, "unseen"])])], names=["text"]))
    for context in (token[0], token[1], kneser_ney.BEGIN, token[-2]):
        log, _ = kneser_ney.Reader(model).log_probabilities(np.full(len(token), context), token)
        assert abs((10**log).sum() - 1) < 1e-9


def test_quality_on_odd_tables(spark):
    documents = frame(spark)
    labels = spark.createDataFrame([(1, 1, 0), (1, 1, 0), (4, 0, 1), (8, 0, 0), (9, None, 0), (None, 1, 0), (6, 1, 1)], "doc_id long, quality int, toxic int")
    for marked in (labels, labels.limit(0)):
        found = quality.score_held_out(documents, marked).collect()
        assert sorted(r.doc_id for r in found) == [i for i, _ in TEXTS]
        assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.5) for r in found)
    assert quality.score_held_out(frame(spark, []), labels).count() == 0


def test_a_worker_that_does_not_see_the_model_fails(tmp_path):
    """No array and no mark: the folder isn't shared, and the scores would be those of an empty model."""
    model = kneser_ney.Model(str(tmp_path / "elsewhere"), 2, 10, 5, (0.5, 1.0, 1.5), (0.5, 1.0, 1.5), 9, (1, 1, 1))
    words = np.array([1, 2, 3], np.uint64)
    with pytest.raises(FileNotFoundError, match="elsewhere"):
        kneser_ney.Reader(model).word_counts(words)
    kneser_ney.write_array(model.folder, kneser_ney.MARK, np.array([2]))
    assert kneser_ney.Reader(model).word_counts(words)[0].tolist() == [0, 0, 0]


def test_a_cluster_names_its_shared_folder():
    from types import SimpleNamespace

    from pitlake.llm.common import shared_dir

    settings = {"spark.sql.warehouse.dir": "/w"}

    def session(master):
        return SimpleNamespace(conf=SimpleNamespace(get=lambda key, default=None: settings.get(key, default)), sparkContext=SimpleNamespace(master=master))

    assert shared_dir(session("local[2]")).startswith("/w/stage-")
    with pytest.raises(ValueError, match="spark.checkpoint.dir"):
        shared_dir(session("spark://host:7077"))
    settings["spark.checkpoint.dir"] = "/shared/"
    assert shared_dir(session("spark://host:7077")).startswith("/shared/stage-")
