"""Fill-in-the-middle, tokenizer alignment and byte-pair encoding against plain versions, on nulls, empty and long texts, repeated rows and special tokens."""

import hashlib
import random
import re
from collections import Counter

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from relfold.llm import bpe, crosstoken, infill
from relfold.llm.queries import QUERIES

sha = lambda text: hashlib.sha256(text.encode()).hexdigest()
r = random.Random(21)
LETTERS = "aabbcdehilnorst' <|>0189.,-_é́ßΣσς数\U0001f600  \t\n\x0b\x1c\x85\xa0᠎  İıẞſͅﬁ▁"


def odd_texts(n):
    out = ["", " ", "  ", "\n", "a", "<|endoftext|>", "x<|startoftext|><|ENDOFTEXT|>y", "</w>", "<s>a</s><unk>", "it's we'll", "a\0b", "<P>x", "a<M>", "<<P", "  ", "x" * 3000, "ab, " * 4000, "é" * 500, "%" * 70]
    for k in range(n):
        text = "".join(r.choices(LETTERS, k=r.randint(0, 40)))
        if k % 5 == 0:
            text += r.choice(["<|endoftext|>", "<|startoftext|>", "<|EndOfText|>", "<S>", "<M>"]) + "x"
        if k % 7 == 0:
            text = "".join(chr(r.choice([r.randint(32, 0x2FFF), r.randint(0x1F000, 0x1FFFF)])) for _ in range(20))
        if k % 11 == 0:
            text = r.choice("aeiozn") * r.randint(1, 90) + r.choice(["", "the", "ing"]) * r.randint(0, 9)
        out.append(text)
    return out


def rows_of(n):
    """Rows with null ids and texts, repeated rows, and equal texts under several ids."""
    rows = [(k, t) for k, t in enumerate(odd_texts(n))]
    return [*rows, *rows[3:9], (None, "a b c"), (None, None), (None, None), (9000, None), *[(9100 + k, "the same text, often") for k in range(60)]]


@pytest.fixture(scope="module")
def small(spark):
    rows = [(*x, "q", "w", 1, "k", "i") for x in rows_of(300)]
    return rows, spark.createDataFrame(rows, "doc_id long, text string, id string, t string, n int, key string, ids string").repartition(5).cache()


@pytest.fixture(scope="module")
def small_folder(small, tmp_path_factory):
    path = str(tmp_path_factory.mktemp("tokens"))
    small[1].write.parquet(f"{path}/documents.parquet")
    return path


def plain_infill(doc_id, text):
    text = text or ""
    units = re.findall("[A-Za-z]+|[^A-Za-z]", text)
    n, digest = len(units), sha(f"1:{'' if doc_id is None else doc_id}")
    h = [int(digest[8 * k : 8 * k + 8], 16) for k in range(4)]
    a, b = sorted((h[0] % (n + 1), h[1] % (n + 1)))
    prefix, middle, suffix = ("".join(x) for x in (units[:a], units[a:b], units[b:]))
    if not text or re.search("<[PSM]>", text) or h[2] % 100 >= 90:
        return n, "plain", None, None, text
    if h[3] % 100 < 20:
        return n, "spm", len(prefix), len(middle), f"<S>{suffix}<P>{prefix}<M>{middle}"
    return n, "psm", len(prefix), len(middle), f"<P>{prefix}<S>{suffix}<M>{middle}"


def test_infill_by_its_definition(small):
    rows, docs = small
    found = Counter(tuple(x) for x in infill.transform(docs).collect())
    assert found == Counter((i, *plain_infill(i, t)) for i, t, *_ in rows)
    assert {x[2] for x in found} == {"plain", "psm", "spm"}


def test_infill_is_undone_exactly(spark, small, small_folder):
    rows, _ = small
    found = QUERIES["op11_fill_in_middle"](spark, small_folder).collect()
    assert Counter((x["doc_id"], x["restored_sha256"]) for x in found) == Counter((i, sha(t or "")) for i, t, *_ in rows)


def test_infill_of_long_texts(spark):
    texts = {1: "ab, " * 500_000 + "x" * 1_000_000, 2: "\U0001f600" * 300_000}
    docs = spark.createDataFrame(list(texts.items()), "doc_id long, text string")
    found = infill.transform(docs).withColumn("text", infill.restored(F.col("form"), F.col("output"))).collect()
    assert {x["id"]: x["text"] for x in found} == texts and {x["id"]: x["n"] for x in found} == {1: 1_500_001, 2: 300_000}


LIBRARY = Tokenizer.from_file(bpe.VOCABULARY)


def test_encoding_and_decoding_as_the_library(spark, small, small_folder):
    rows, docs = small
    expected = Counter()
    for i, t, *_ in rows:
        ids = LIBRARY.encode(t or "", add_special_tokens=False).ids
        expected[i, len(ids), sha(" ".join(map(str, ids))), sha(LIBRARY.decode(ids, skip_special_tokens=False))] += 1
    assert Counter(map(tuple, QUERIES["op13_bpe"](spark, small_folder).collect())) == expected


def test_decoding_apart_from_encoding(small):
    _, docs = small
    apart, together = bpe.decode(bpe.encode(docs)), bpe.encode(docs, decoded=True)
    assert Counter(map(str, apart.collect())) == Counter(map(str, together.collect()))


def test_many_odd_texts_as_the_library():
    texts = odd_texts(20_000)
    found = [x.tolist() for x in bpe.Encoder(bpe.Vocabulary()).encode(texts)]
    assert found == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]


def test_tables_that_are_emptied_give_the_same(monkeypatch):
    for name, value in (("KEPT_WORDS", 50), ("KEPT_PAIRS", 40), ("GROUP_WORDS", 30), ("SIDE_BY_SIDE", 5)):
        monkeypatch.setattr(bpe, name, value)
    texts = odd_texts(400)
    encoder = bpe.Encoder(bpe.Vocabulary())
    assert [x.tolist() for x in encoder.encode(texts)] == [e.ids for e in LIBRARY.encode_batch(texts, add_special_tokens=False)]
    assert len(encoder.known_words) <= 60


def plain_merges(vocabulary, text):
    """Tokens by merging the pair of lowest rank, leftmost first."""
    row = [vocabulary.ids[x] for x in (*text[:-1], text[-1] + bpe.END)]
    while True:
        ranks = [(vocabulary.merge[p], k) for k, p in enumerate(zip(row, row[1:], strict=False)) if p in vocabulary.merge]
        if not ranks:
            return row
        k = min(ranks)[1]
        joined = [m for m, parts in enumerate(vocabulary.parts) if parts == (row[k], row[k + 1])]
        row[k : k + 2] = joined


def test_pieces_are_what_merging_by_rank_gives():
    vocabulary = bpe.Vocabulary()
    encoder = bpe.Encoder(vocabulary)
    pieces = ["".join(r.choices("aeinorst", k=r.randint(1, 12))) for _ in range(60)] + ["aaaa", "aaaaa", "zzzzzzz"]
    plain = [plain_merges(vocabulary, p) for p in pieces]
    assert [np.frombuffer(x, np.int32).tolist() for x in encoder.pieces(pieces)] == plain == [np.frombuffer(encoder.long_piece(p), np.int32).tolist() for p in pieces]


def test_every_token_encodes_to_itself():
    vocabulary = bpe.Vocabulary()
    whole = {t[:-1]: i for t, i in vocabulary.ids.items() if t.endswith(bpe.END)}
    assert [np.frombuffer(x, np.int32).tolist() for x in bpe.Encoder(vocabulary).pieces(list(whole))] == [[i] for i in whole.values()]


def test_long_words_and_null_lists(spark):
    docs = spark.createDataFrame([(1, "x" * 200_000), (2, "<|endoftext|>" * 3)], "doc_id long, text string")
    found = {x["id"]: x["ids"] for x in bpe.encode(docs).collect()}
    assert found == {1: LIBRARY.encode("x" * 200_000, add_special_tokens=False).ids, 2: [49407] * 3}
    lists = spark.createDataFrame([(1, None), (2, []), (3, [320, 49407])], "id long, ids array<int>")
    assert [x["decoded"] for x in bpe.decode(lists).orderBy("id").collect()] == ["", "", "a</w> <|endoftext|>"]


def test_other_files_are_refused():
    with pytest.raises(ValueError, match="kind"):
        bpe.Vocabulary(public_tokenizers.path("byte_bpe_50k.json"))
    with pytest.raises(ValueError, match="kind"):
        crosstoken.read_ranks(bpe.VOCABULARY)


def plain_alignment(rows):
    """Measures of each row by the definition, with counts over all rows."""
    first = Tokenizer.from_file(crosstoken.BYTE_LEVEL)
    first.encode_special_tokens = True
    second = sentencepiece.SentencePieceProcessor(model_file=crosstoken.PIECES)
    letters = crosstoken.byte_letters()
    token_bytes = {i: bytes(letters[c] for c in t) for t, i in first.get_vocab().items() if i < 50256}
    piece = lambda i: bytes([int(second.id_to_piece(i)[3:5], 16)]) if second.is_byte(i) else second.id_to_piece(i).replace("▁", " ").encode()
    found, usual = [], Counter()
    for _, text in rows:
        raw, ids = (" " + (text or "")).encode(), ([], [])
        if text:
            ids = first.encode(" " + text, add_special_tokens=False).ids, second.encode(text)
        parts = [token_bytes[i] for i in ids[0]], [piece(i) for i in ids[1]]
        if not text or any(b"".join(p) != raw for p in parts):
            found.append(None)
            continue
        ends = [list(np.cumsum([len(x) for x in p])) for p in parts]
        common, links, groups, at = sorted(set(ends[0]) & set(ends[1])), Counter(), [], [0, 0]
        for c in common:
            group = []
            for k in range(2):
                stop = ends[k].index(c) + 1
                group.append(ids[k][at[k] : stop])
                at[k] = stop
            groups.append(group)
            links.update((a, b) for a in group[0] for b in group[1])
        usual.update(links.keys())
        found.append((ids, groups, links))
    best = {}
    for (a, _), n in usual.items():
        best[a] = max(best.get(a, 0), n)
    out = Counter()
    for (i, _), x in zip(rows, found, strict=True):
        if x is None:
            out[i, 0, 0, 0, 0, 0, 0, ""] += 1
            continue
        ids, groups, links = x
        written = ";".join("|".join(",".join(map(str, g)) for g in group) for group in groups)
        n_best, total = sum(n for p, n in links.items() if usual[p] == best[p[0]]), sum(n * usual[p] for p, n in links.items())
        out[i, len(ids[0]), len(ids[1]), len(groups), sum(links.values()), n_best, total, sha(written)] += 1
    return out


@pytest.mark.parametrize(("pair_share", "text_share", "wide"), [(1 << 18, 1 << 12, 256), (20, 2, 3), (1, 1, 1)])
def test_alignment_by_its_definition(monkeypatch, small, pair_share, text_share, wide):
    for name, value in (("PAIR_SHARE", pair_share), ("TEXT_SHARE", text_share), ("WIDE_GROUP", wide)):
        monkeypatch.setattr(crosstoken, name, value)
    rows, docs = small
    expected = plain_alignment([x[:2] for x in rows])
    found = crosstoken.align(docs)
    assert Counter(map(tuple, found.collect())) == expected and len([x for x in expected if x[1]]) > 200
    assert found.columns == ["id", *crosstoken.MEASURES, "groups_sha256"]


def test_alignment_of_one_wide_group():
    with open(crosstoken.PIECES, "rb") as file:
        aligner = crosstoken.Aligner(crosstoken.read_ranks(), file.read())
    ids, group = [np.array([5, 6, 5]), np.array([7, 7, 8, 9])], [np.zeros(3, np.int64), np.zeros(4, np.int64)]
    expected = Counter((a << 32 | b) for a in ids[0].tolist() for b in ids[1].tolist())
    for wide in (1, 1000):
        crosstoken.WIDE_GROUP, kept = wide, crosstoken.WIDE_GROUP
        assert dict(zip(*(x.tolist() for x in aligner.pairs(ids, group, 1)), strict=True)) == expected
        crosstoken.WIDE_GROUP = kept


def test_both_readers_of_the_byte_level_file_agree():
    with open(crosstoken.PIECES, "rb") as file:
        aligner = crosstoken.Aligner(crosstoken.read_ranks(), file.read())
    library = Tokenizer.from_file(crosstoken.BYTE_LEVEL)
    library.encode_special_tokens = True
    texts = [*odd_texts(2000), *[f"a{chr(c)}b {chr(c)}1" for c in range(0x20, 0x30000, 7) if not 0xD800 <= c < 0xE000]]
    assert [aligner.a.encode_ordinary(" " + t) for t in texts] == [e.ids for e in library.encode_batch([" " + t for t in texts], add_special_tokens=False)]
