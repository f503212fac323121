import hashlib
from collections import Counter

import pytest

from tallyfold.llm import alignment as al

public_tokenizers = pytest.importorskip("public_tokenizers")
PATHS = public_tokenizers.path("byte_bpe_50k.json"), public_tokenizers.path("piece_bpe_32k.model")
COLUMNS = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]


def spans(ids, size):
    at, out = 0, []
    for i in ids:
        out.append((i, at, at + size(i)))
        at += size(i)
    return out


def brute(docs):
    """Token by token, every overlap by comparing byte ranges."""
    from tokenizers import Tokenizer
    import sentencepiece

    first = Tokenizer.from_file(PATHS[0])
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=PATHS[1])
    letters = al.byte_of_letter()

    def a_bytes(i):
        return bytes(letters[c] for c in first.id_to_token(i))

    def b_bytes(i):
        return bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()

    done = []
    for doc_id, text in docs:
        whole = (" " + (text or "")).encode()
        a = first.encode(" " + (text or ""), add_special_tokens=False).ids if text else []
        b = second.encode(text) if text else []
        if b"".join(map(a_bytes, a)) != whole or b"".join(map(b_bytes, b)) != whole or not text:
            a, b = [], []
        sa, sb = spans(a, lambda i: len(a_bytes(i))), spans(b, lambda i: len(b_bytes(i)))
        links, j = [], 0
        for x, p, q in sa:
            while sb[j][2] <= p:
                j += 1
            k = j
            while k < len(sb) and sb[k][1] < q:
                links.append((x, sb[k][0]))
                k += 1
        ends = sorted({e for *_, e in sa} & {e for *_, e in sb})
        groups, at = [], 0
        for e in ends:
            groups.append(",".join(str(i) for i, p, q in sa if at < q <= e) + "|" + ",".join(str(i) for i, p, q in sb if at < q <= e)
                          if len(text) < 5000 else None)
            at = e
        done.append((doc_id, len(a), len(b), len(groups), links, groups))
    count = Counter(link for *_, links, _ in done for link in links)
    most = Counter()
    for (_, b), n in count.items():
        most[b] = max(most[b], n)
    return sorted(((d, na, nb, ng, len(links), sum(count[x] == most[x[1]] for x in links), sum(count[x] for x in links),
                    None if None in groups else hashlib.sha256(";".join(groups).encode()).hexdigest() if groups else "")
                   for d, na, nb, ng, links, groups in done), key=repr)


def same(got, want):
    got = sorted((tuple(r[c] for c in COLUMNS) for r in got), key=repr)
    assert len(got) == len(want)
    for x, y in zip(got, want):
        assert x[:7] == y[:7] and y[7] in (None, x[7])


@pytest.fixture(scope="module")
def awkward():
    return ["<|endoftext|> and <s> </s> <unk> <0x41>", "a  b   c    d\n\n\te   f", "▁ lower ▁▁ blocks", "ﬁ é é Å",
            "\U0001f600\U0001f468‍\U0001f469‍\U0001f467", "x" * 3000, " ", "  lead", "trail  ", "\x00\x01\x7f", "we're they'll I'd",
            "1234567890" * 30, "中文字符 русский", "-" * 500 + "=" * 333, "한국어" * 40]


def test_odd_rows(spark, odd, odd_rows, clashing, awkward):
    rows = [r[:2] for r in odd_rows]
    want = brute(rows)
    for docs in (odd, clashing):
        same(al.align_tokenizers(docs, *PATHS)[0].collect(), want)
    more = [*rows, *enumerate(awkward, 100)]
    frame = spark.createDataFrame(more, "doc_id long, text string").repartition(3)
    same(al.align_tokenizers(frame, *PATHS)[0].collect(), brute(more))


def test_rare_pairs_by_the_shuffle(spark, sf, monkeypatch):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    rows = [tuple(r) for r in docs.select("doc_id", "text").collect()]
    want = brute(rows)
    for sent in (al.PAIRS_SENT, 50):
        monkeypatch.setattr(al, "PAIRS_SENT", sent)
        same(al.align_tokenizers(docs, *PATHS)[0].collect(), want)


def test_units_are_what_whole_texts_are(awkward):
    own = al.tokenizers_of(*PATHS)
    assert own.cuts
    more = ["a b", "a  b ", " a", "a ", "  ", "a\n b", "a\u00a0 b", "a \n b\t", "x \u3000 y", "it's 'll  's", "\n\n  \n x", "a\x1c b"]
    for text in [*awkward, *more, " ".join([t for t in awkward if "▁" not in t] + more)]:
        units = own.units(text)
        assert "".join(units) == " " + text
        a, b, sizes = own.encode(units)
        if "▁" in text:  # a letter of its own, which the second tokenizer takes for a space
            assert 0 in sizes
            continue
        assert a.tolist() == own.first.encode(" " + text, add_special_tokens=False).ids and b.tolist() == own.second.encode(text)
        assert sizes.tolist() == [len(u.encode()) for u in units]


def test_what_is_remembered_is_what_is_found(awkward, monkeypatch):
    own = al.tokenizers_of(*PATHS)
    whole = al.documents_linked(al.Memory(own), awkward)
    monkeypatch.setattr(al, "REMEMBERED_UNITS", 3)
    monkeypatch.setattr(al, "LEARNED_AT_ONCE", 2)
    memory = al.Memory(own)
    for i, text in enumerate(awkward):
        part = al.documents_linked(memory, [text])
        a, b = whole["cuts"][i : i + 2]
        assert part["digests"] == [whole["digests"][i]] and part["counts"].tolist() == [whole["counts"][i].tolist()]
        assert part["direct"] == [whole["direct"][i]] and part["pairs"].tolist() == whole["pairs"][a:b].tolist()


def test_pairs_of_a_link_table(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    own = al.tokenizers_of(*PATHS)
    rows, counts = al.align_tokenizers(docs, *PATHS)
    table = counts.toPandas()
    assert table["n"].sum() == sum(r["n_links"] for r in rows.collect())
    assert (table.groupby("second")["best"].sum() >= 1).all()
    assert (table["pair"] == table["first"] * len(own.second_bytes) + table["second"]).all()


def test_no_rows(none):
    rows, counts = al.align_tokenizers(none, *PATHS)
    assert rows.collect() == [] and counts.collect() == []
