"""Operators on texts against plain Python."""

import random
import re
import zlib
from collections import Counter, defaultdict
from itertools import product
from math import log10

import numpy as np
import pytest
from pyspark.sql import functions as F

from tallyfold.llm import decontaminate, language_model, neardup, passages, quality, tokens, toxicity
from tallyfold.llm.words import encoded, shingle_sets, words_of

from .conftest import DOCS, words


def split(text):
    return (text or "").encode().lower().split()


def shingles(text):
    w = split(text)
    return {tuple(w[i : i + 5]) for i in range(len(w) - 4)} if len(w) >= 5 else {tuple(w)} if w else set()


@pytest.fixture(scope="module")
def docs(spark, sf):
    return spark.read.parquet(f"{sf}/documents.parquet")


@pytest.fixture(scope="module")
def plain(docs):
    return {r.doc_id: r for r in docs.collect()}


@pytest.fixture(scope="module")
def tokenizer():
    import public_tokenizers

    return public_tokenizers.path("word_bpe_49k.json")


def test_words_and_shingles_are_those_of_the_pattern(odd_rows):
    texts = [r[1] for r in odd_rows]
    found = words_of(encoded(texts))
    own = {}
    for i, t in enumerate(texts):
        expected = re.findall("[^\x20\x09-\x0d]+", t or "")
        assert found.bounds[i + 1] - found.bounds[i] == len(expected)
        for h, s, n, w in zip(*(x[found.bounds[i] : found.bounds[i + 1]] for x in (found.hash, found.start, found.size)), expected):
            assert (t or "").encode()[s : s + n] == w.encode()
            assert own.setdefault(w.encode().lower(), h) == h
    assert len(set(own.values())) == len(own)
    assert [len(s) for s in shingle_sets(found)] == [len(shingles(t)) for t in texts]


@pytest.mark.parametrize("top", [200, 300, 70_000, 2**32])
def test_codes_round_trip_and_random_access(top):
    ids = np.random.default_rng(1).integers(0, top, 5000).astype(np.uint32)
    codes = tokens.Codes(tokens.pack(ids))
    assert (codes.all() == ids).all()
    assert [codes[i] for i in range(0, 5000, 37)] == ids[::37].tolist()
    assert len(tokens.Codes(tokens.pack(np.zeros(0, np.uint32))).all()) == 0


def test_token_files_hold_the_ids_of_the_whole_texts(docs, plain, tokenizer):
    from tokenizers import Tokenizer

    own = Tokenizer.from_file(tokenizer)
    found = sorted(tokens.token_files(docs, tokenizer).collect(), key=lambda r: r.doc_id)
    start = 0
    for r in found:
        ids = np.array([*own.encode(plain[r.doc_id].text or "", add_special_tokens=False).ids, 1], "<u4")
        assert (r.start, r.n_tokens, r.ids_crc32) == (start, len(ids), zlib.crc32(ids.tobytes()))
        start += len(ids)
    assert len(found) == len(plain)


def test_word_ids_are_those_of_whole_texts(tokenizer):
    odd = ["Foo, bar. don't it's I'LL end's. a<|endoftext|>B! <|ENDOFTEXT|> x\x00y \x00 ÉCOLE, İstanbul ﬁ Å ́a á. 3.14 10, (ok), ok), A.B. !?.,",
           "U\x85V W\xa0X \x1c y z end.\x1f Σίσυφος ΣΑΣ a... can't. we've, They'd; 'S 'S.", "", "  "]
    own = tokens.TextEncoder(tokenizer)
    for text, ids in zip(odd, own.encode(encoded(odd))):
        assert ids.tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids


def components(sets):
    root = {i: i for i in sets}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    at = defaultdict(list)
    for i, s in sets.items():
        for x in s:
            at[x].append(i)
    shared = Counter((a, b) for own in at.values() for k, a in enumerate(own) for b in own[:k])
    for (a, b), n in shared.items():
        if 100 * n >= 75 * (len(sets[a]) + len(sets[b]) - n):
            a, b = find(a), find(b)
            root[max(a, b)] = min(a, b)
    return {i: find(i) for i in sets}


def test_near_duplicates_are_the_components_of_all_links(docs, plain):
    sets = {i: shingles(r.text) for i, r in plain.items()}
    expected = components(sets)
    found = {r.doc_id: r for r in neardup.near_duplicates(docs).collect()}
    assert {i: r.component_id for i, r in found.items()} == expected
    assert all(r.n_shingles == len(sets[i]) and r.kept == (expected[i] == i) for i, r in found.items())
    assert {r.doc_id for r in neardup.drop_near_duplicates(docs).collect()} == {i for i, c in expected.items() if i == c}


def test_chained_near_copies_are_one_component(spark):
    rng = random.Random(5)
    text, rows = words(rng, 120), []
    for i in range(30):  # each like the one before, the last unlike the first
        rows.append((i, " ".join(text), "en", "a", 1))
        for _ in range(2):
            text[rng.randrange(len(text))] = f"new{rng.random()}"
    df = spark.createDataFrame(rows, DOCS)
    found = {r.doc_id: r.component_id for r in neardup.near_duplicates(df).collect()}
    assert found == components({r[0]: shingles(r[1]) for r in rows})


def test_chained_near_copies_whose_ids_have_other_long_texts(spark):
    rng = random.Random(5)
    text, rows = words(rng, 120), []
    for i in range(30):
        rows.append((i, " ".join(text), "en", "a", 1))
        rows.append((i, " ".join(words(rng, 600)), "en", "a", 1))
        for _ in range(2):
            text[rng.randrange(len(text))] = f"new{rng.random()}"
    found = neardup.near_duplicates(spark.createDataFrame(rows, DOCS)).collect()
    assert len(found) == 60 and {r.component_id for r in found} == {0}


def test_benchmark_items_inside_documents(spark, sf, docs, plain):
    benchmark = spark.read.parquet(f"{sf}/benchmark.parquet")
    items = {r.item_id: shingles(r.text) for r in benchmark.collect()}
    expected = {(i, k): len(own & shingles(r.text)) for i, r in plain.items() for k, own in items.items()
                if own and 100 * len(own & shingles(r.text)) >= 75 * len(own)}
    found = decontaminate.contained(docs, benchmark).collect()
    assert {(r.doc_id, r.item_id): r.n_shared for r in found} == expected and expected
    left = {r.doc_id for r in decontaminate.decontaminate(docs, benchmark).collect()}
    assert left == set(plain) - {i for i, _ in expected}


def test_language_model(docs, plain, monkeypatch):
    monkeypatch.setattr(language_model, "CHUNK_BYTES", 100_000)
    own = {i: [*split(r.text), b""] for i, r in plain.items()}
    held = {i: zlib.crc32(str(i).encode()) % 7 == 2 for i in own}
    count = Counter(w for i, ws in own.items() if not held[i] for w in ws)
    n, kinds = count.total(), len(count)
    found = {r.doc_id: r for r in language_model.score_texts(docs).collect()}
    for i, ws in own.items():
        r = found[i]
        assert (r.held_out, r.n_tokens, r.n_known, r.train_tokens) == (held[i], len(ws), sum(w in count for w in ws), n)
        assert r.base_score == pytest.approx(sum(log10((count[w] + 1) / (n + kinds + 1)) for w in ws))
    new = [r for r in found.values() if r.held_out]
    assert sum(r.score for r in new) > sum(r.base_score for r in new)


def test_language_model_is_the_mixture_of_its_counts(spark):
    rng = random.Random(2)
    texts = [" ".join(rng.choice(["a", "b", "c d", "d e f"]) for _ in range(30)) for _ in range(40)]
    df = spark.createDataFrame([(i, t, "en", "a", 1) for i, t in enumerate(texts)], DOCS)
    found = language_model.score_texts(df).collect()
    # every word has followed each context often, so probabilities of all next words add up to one within the add-one rest
    own = [t.split() for i, t in enumerate(texts) if zlib.crc32(str(i).encode()) % 7 != 2]
    pairs, heads = Counter(), Counter()
    for w in own:
        full = ["", *w, ""]
        pairs.update(zip(full, full[1:]))
        heads.update(full[:-1])
    for r in found:
        full = ["", *texts[r.doc_id].split(), ""]
        top = sum(log10(max(pairs[x], 1) / heads[x[0]]) for x in zip(full, full[1:]))
        assert r.base_score < r.score < 0 and r.score == pytest.approx(top, rel=0.1)


def test_packed_numbers():
    for top in (0, 1, 255, 256, 2**40, 2**63):
        x = np.array([0, top // 2, top], np.uint64)
        assert (language_model.unpack_ints(language_model.pack_ints(x)) == x).all()
    assert len(language_model.unpack_ints(language_model.pack_ints(np.zeros(0, np.uint64)))) == 0


def test_passages_cover_every_long_repeat(docs, plain):
    where = defaultdict(set)
    for i, r in plain.items():
        w = split(r.text)
        for k in range(len(w) - 50):
            where[tuple(w[k : k + 51])].add(i)
    repeated = {i for own in where.values() if len(own) > 1 for i in own}
    found = passages.repeated_passages(docs).collect()
    assert repeated <= {i for r in found for i in (r.doc_id, r.other_id)}
    for r in found:
        if r.kind == "passage" and not r.n_changed:
            assert split(plain[r.doc_id].text)[r.start_word : r.end_word] == split(plain[r.other_id].text)[r.other_start : r.other_end]


def test_fuzzy_passages(spark):
    rng = random.Random(9)
    passage = words(rng, 90)
    edited = list(passage)
    edited[30] = "changed"
    del edited[60]
    rows = [(1, " ".join(words(rng, 50) + passage + words(rng, 50)), "en", "a", 1), (2, " ".join(words(rng, 20) + edited), "en", "a", 1),
            (3, " ".join(words(rng, 200)), "en", "a", 1)]
    (r,) = passages.repeated_passages(spark.createDataFrame(rows, DOCS)).collect()
    assert (r.doc_id, r.other_id, r.start_word, r.end_word, r.other_start, r.other_end, r.n_changed) == (2, 1, 20, 109, 50, 140, 2)


def test_exact_passages_in_the_same_order_at_any_gap(spark):
    rng = random.Random(21)
    rows, own = [], []
    for gap in range(20, 301, 40):
        for size in (60, 100, 200):
            one, two = words(rng, size), words(rng, size)
            for _ in range(2):
                rows.append((len(rows), " ".join([*words(rng, 30), *one, *words(rng, gap), *two, *words(rng, 30)]), "en", "a", 1))
            own.append((len(rows) - 1, size, gap))
    found = defaultdict(set)
    for r in passages.repeated_passages(spark.createDataFrame(rows, DOCS)).collect():
        assert r.other_id == r.doc_id - 1 and 4 * r.n_changed <= r.end_word - r.start_word
        found[r.doc_id].update(range(r.start_word, r.end_word))
    for i, size, gap in own:
        assert {*range(30, 30 + size), *range(30 + size + gap, 30 + 2 * size + gap)} <= found[i], (size, gap)


def test_passage_whose_halves_have_other_homes(spark):
    rng = random.Random(22)
    rows, own = [], []
    for size in (50, 53, 60, 90):
        for over in (0, 7, 30):
            passage = words(rng, size)
            first, second = passage[: (size + over) // 2], passage[(size - over) // 2 :]
            for i, part in enumerate((first, second, passage, passage)):
                text = [*words(rng, 30), *part, *words(rng, 30)]
                rows.append((len(rows), " ".join(text), "en", "a", 1))
            own.append((len(rows) - 1, size, over))
    found = defaultdict(set)
    for r in passages.repeated_passages(spark.createDataFrame(rows, DOCS)).collect():
        if r.other_id == r.doc_id - 1:
            found[r.doc_id].update(range(r.start_word, r.end_word))
    for i, size, over in own:
        assert set(range(30, 30 + size)) <= found[i], (size, over)


def test_recall_of_edited_passages(spark):
    rng = random.Random(23)
    rows, own = [], []
    for size, percent, least in ((50, None, 20), (60, 5, 20), (60, 10, 19), (100, 10, 20), (100, 15, 19), (100, 20, 16)):
        for _ in range(20):
            passage = words(rng, size)
            edited = list(passage)
            # one word in eight, evenly, or the share at random
            for i in range(4, size, 8) if percent is None else rng.sample(range(size), size * percent // 100):
                edited[i] = f"changed{i}"
            for part in (passage, edited):
                rows.append((len(rows), " ".join([*words(rng, 30), *part, *words(rng, 30)]), "en", "a", 1))
            own.append((len(rows) - 1, size, percent, least))
    found = defaultdict(set)
    for r in passages.repeated_passages(spark.createDataFrame(rows, DOCS)).collect():
        if r.other_id == r.doc_id - 1:
            found[r.doc_id].update(range(r.start_word, r.end_word))
    hits = Counter()
    for i, *case in own:
        # found: four fifths of its words are in ranges
        hits[tuple(case)] += len(found[i] & set(range(30, 30 + case[0]))) >= 0.8 * case[0]
    assert all(hits[case] >= case[2] for case in hits), hits


def test_runs_that_may_repeat():
    n, step = passages.LEAST_WORDS + 40, passages.WINDOW
    assert passages.may_repeat(np.arange(0, n, step), n).tolist() == list(range(41))
    assert not len(passages.may_repeat(np.array([0, n - 20]), n)) and not len(passages.may_repeat(np.array([3]), 30))
    assert passages.needed(np.arange(20, 120), np.arange(50, 150)).tolist() == sorted(
        {0, 99} | {i for i in range(100) if (i + 20) % passages.SEED_WORDS == 0})


def test_distance_of_gaps_is_that_of_the_table():
    rng = random.Random(5)
    for _ in range(300):
        a, b = [[rng.choice("abcd") for _ in range(rng.randint(0, 12))] for _ in range(2)]
        row = list(range(len(b) + 1))
        for i, x in enumerate(a, 1):
            last, row[0] = row[0], i
            for j, y in enumerate(b, 1):
                last, row[j] = row[j], min(last + (x != y), row[j] + 1, row[j - 1] + 1)
        assert passages.edit_distance(a, b) == row[-1]


def test_chains_are_the_best_of_all():
    rng = np.random.default_rng(4)
    for trial in range(30):
        n = 7
        x, y = rng.integers(0, 60, n), rng.integers(0, 60, n)
        if trial % 2:  # mostly one line of matches
            x, y = np.sort(x) * 3, np.sort(y) * 3

        def value(chain):
            v = 2.0 * passages.SEED_WORDS
            for a, b in zip(chain, chain[1:]):
                gain = v - passages.GAP_COST * (x[b] - x[a] + y[b] - y[a])
                v = gain + 2 * passages.SEED_WORDS if gain > 0 else 2.0 * passages.SEED_WORDS
            return v

        def orders(last):
            yield [last]
            for i in range(n):
                if x[i] < x[last] and y[i] < y[last]:
                    yield from ([*c, last] for c in orders(i))

        best = max(value(c) for i in range(n) for c in orders(i))
        assert value(passages.chains(x, y)[0]) == pytest.approx(best)


def test_quality_measures(docs, plain, odd, odd_rows):
    found = [(r, plain[r.doc_id].text) for r in quality.quality_report(docs).collect()]
    for r, text in found:
        w = re.findall("[^\x20\x09-\x0d]+", text or "")
        windows = [tuple(w[i : i + 5]) for i in range(len(w) - 4)]
        times = Counter(windows)
        repeat = len({i + j for i, x in enumerate(windows) if times[x] > 1 for j in range(5)})
        seen, dup = set(), 0
        for line in (text or "").split("\n"):
            if re.search("[^\x20\x09-\x0d]", line):
                dup += line in seen
                seen.add(line)
        expected = (len(w), sum(map(len, w)), len(re.findall(r"[#*$%&|<>]", text or "")), dup, repeat)
        assert (r.n_words, r.word_chars, r.n_symbols, r.n_dup_lines, r.n_repeat_words) == expected
        assert r.base_failed == (len(w) < 10 or 100 * repeat > 20 * len(w))
        assert not (r.kept and r.base_failed)
    assert sum(r.n_words or 0 for r in quality.quality_report(odd).collect()) == sum(len(split(t[1])) for t in odd_rows)


def test_quality_keeps_clean_and_rejects_junk(spark, sf, docs):
    labels = {r.doc_id: r.quality for r in spark.read.parquet(f"{sf}/labels.parquet").collect()}
    report = {r.doc_id: r for r in quality.quality_report(docs).collect()}
    good = [report[i] for i, q in labels.items() if q == 1 and not report[i].base_failed]
    assert all(r.kept for r in good)
    kept = {r.doc_id for r in quality.good_documents(docs).collect()}
    assert kept == {i for i, r in report.items() if r.kept}


def test_distance():
    assert quality.distance(np.array([1.0, 0]), np.array([0, 2.0])) == 1
    assert quality.distance(np.array([1.0, 3]), np.array([2.0, 6])) == 0


def test_marginals_are_those_of_all_taggings():
    rng = np.random.default_rng(0)
    field = toxicity.Field(*(rng.normal(size=toxicity.CODES) for _ in range(3)), rng.normal(size=2), rng.normal(size=(2, 2)))
    code, first = rng.integers(0, toxicity.CODES, 9), np.zeros(9, bool)
    first[[0, 4, 5]] = True
    score, total, toxic = toxicity.scores(code, first, field), 0.0, np.zeros(9)
    for tags in product((0, 1), repeat=9):
        value = sum(score[t] * g + (field.start[g] if first[t] else field.moves[tags[t - 1], g]) for t, g in enumerate(tags))
        total += np.exp(value)
        toxic += np.exp(value) * np.array(tags)
    assert toxicity.word_marginals(code, first, field) == pytest.approx(toxic / total)


def test_toxicity_on_held_out_labels(spark):
    folder = "/root/testdata/sf0.01"
    docs, labels = (spark.read.parquet(f"{folder}/{t}.parquet") for t in ("documents", "labels"))
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, labels))
    rows = scored.join(labels, "doc_id").where(toxicity.held_out(F.col("doc_id"))).collect()
    assert sum(r.predicted == r.toxic for r in rows) >= 0.9 * len(rows)
    texts = {r.doc_id: r.text for r in docs.collect()}
    for r in scored.collect():
        assert 0 <= r.score <= 1 and all(0 <= s.start < s.end <= len(texts[r.doc_id]) for s in r.spans)


def test_long_rows_take_part_in_the_fit(spark):
    rng = random.Random(5)
    plain, bad = [f"word{i}" for i in range(300)], ["vilelythe", "scumbeast", "rotgutter"]

    def text(n, toxic):
        words = rng.choices(plain, k=n)
        for _ in range(6 if toxic else 0):
            words[rng.randrange(n)] = rng.choice(bad)
        return " ".join(words)

    # all toxic rows are longer than a sampled window, all clean ones short
    rows = [(i, text(2100 if i % 2 else 60, i % 2), "en", "a", 1) for i in range(160)]
    labels = spark.createDataFrame([(i, i % 2) for i in range(160)], "doc_id long, toxic int")
    docs = spark.createDataFrame(rows, DOCS)
    scored = toxicity.score_toxicity(docs, toxicity.train(docs, labels)).collect()
    assert sum(r.predicted for r in scored if r.doc_id % 2) >= 76 and not sum(r.predicted for r in scored if r.doc_id % 2 == 0)
    lexicon = {b"wvilelythe": 3.0}
    long = b" ".join([b"a"] * 3000 + [b"vilelythe"] + [b"b"] * 500)
    window = toxicity.densest(long, lexicon).split()
    assert len(window) == toxicity.SAMPLE_WORDS and b"vilelythe" in window


def test_words_with_accents_are_cut_before_the_tokenizer():
    seen = []

    class Watched(tokens.TextEncoder):
        def _tokenize(self, words):
            seen.extend(words)
            super()._tokenize(words)

    import public_tokenizers

    own = Watched(public_tokenizers.path("word_bpe_49k.json"))
    odd = ["\u00e9lan Caf\u00e9", "\u00e9lan. caf\u00e9,*** \u00c9LAN&&& caf\u00e9's", "\u0130x\u0130. \u0131\u00d7. \u00d7, H\u0331a. h\u0331 e\u0301. \u03a3\u03a3. \u044f. 9.\u00e9 \u00e9<|endoftext|>."]
    for text in odd:
        assert own.encode([text.encode()])[0].tolist() == own.tokenizer.encode(text, add_special_tokens=False).ids
    texts = ["", "Abc.", "", "D\u00e9f, h\u0331!", "G.h <|x", "I9?!"]
    assert tokens.spaced([x.encode() for x in texts]) == [x.encode() for x in ("", "abc .", "", texts[3], texts[4], "i9 ?!")]
    assert "\u00e9lan.".encode() not in seen and "caf\u00e9,***".encode() not in seen


def test_workers_give_back_what_a_batch_took(monkeypatch):
    import pandas as pd

    from tallyfold.llm import words as w

    calls = []
    monkeypatch.setattr(w, "give_back", lambda: calls.append(1))
    assert list(w.sparing(iter([1, 2, 3]))) == [1, 2, 3] and len(calls) == 3
    # texts of one batch are cut into words half a megabyte at a time
    batch = pd.DataFrame({"text": ["word " * 20_000] * 20, "lang": ["en"] * 20})
    parts = [sum(map(len, texts)) for _, texts in quality._by_lang(batch)]
    assert sum(parts) == 2_000_000 and max(parts) <= 1 << 19
