"""op6 and op8 against the tokenizers library on whole texts."""

import zlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from tidemark.llm import packing, token_orc
from tidemark.llm.queries import vocabulary
from tidemark.llm.tokens import encoder

FILES = ["word_bpe_49k.json", "byte_bpe_50k.json"]
ODD = ["", " ", "  a  b\n\n c ", "don't 've\t\r\n x  ", "<|endoftext|> a<|endoftext|>b", "é ́x", " a　  b", "\x1c!\x1c \x1fy", "ΑΣ ς İ", "a" * 5000, "1234567 8", "\U0001f600 \U0001f600x", "​x ​"]


def whole(path, text):
    from tokenizers import Tokenizer

    return np.array(Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids, "<u4").tobytes()


@pytest.mark.parametrize("file", FILES)
def test_odd_texts(file):
    path = vocabulary(file)
    for t in ODD:
        assert encoder(path).ids(t) == whole(path, t), repr(t)
    assert encoder(path).ids(None) == b""


LETTERS = st.text(alphabet=st.one_of(st.sampled_from(" \n\t  '!.<|>aAé1́sS"), st.characters(blacklist_categories=["Cs"])), max_size=40)


@pytest.mark.parametrize("file", FILES)
def test_any_text(file):
    from tokenizers import Tokenizer

    path = vocabulary(file)
    tok, enc = Tokenizer.from_file(path), encoder(path)

    @settings(max_examples=400, deadline=None)
    @given(LETTERS)
    def same(t):
        assert enc.ids(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()

    same()


WORDS = st.lists(st.from_regex(r"[ \n]?[A-Za-z\xc0-\xff\u0130\u0301]{1,12}[.,;:!?'*<|>\-%$#~^`\"]{0,4}", fullmatch=True), max_size=12).map("".join)


@pytest.mark.parametrize("file", FILES)
def test_plain_words(file, monkeypatch):
    """Words as the model alone encodes them, also while what is known makes room."""
    from tidemark.llm import tokens

    monkeypatch.setattr(tokens, "KEPT", 20)
    tok, enc = tokens.Encoder(vocabulary(file)).tokenizer, tokens.Encoder(vocabulary(file))
    assert enc.plain

    @settings(max_examples=600, deadline=None)
    @given(WORDS)
    def same(t):
        assert enc.ids(t) == np.array(tok.encode(t, add_special_tokens=False).ids, "<u4").tobytes()
        assert len(enc.known) <= 20 + 13

    same()


def rows_of(spark, extra=False):
    texts = [*ODD, None, "word " * 9000, "repeat", "repeat"]
    rows = [(i * 7 % 23, t, "x", i) for i, t in enumerate(texts)] + [(3, "repeat", None, 1), (None, "no id", "s", 2)]
    return spark.createDataFrame(rows, "doc_id long, text string, part string, ids long").repartition(3)


def test_orc_round_trip(spark):
    path = vocabulary("word_bpe_49k.json")
    docs = rows_of(spark)
    got = token_orc.round_trip(docs, path).collect()
    want, at = [], 0
    rows = sorted(docs.collect(), key=lambda r: (r.doc_id is not None, r.doc_id, r.text or ""))
    for r in rows:
        ids = whole(path, r.text or "") + np.array([2], "<u4").tobytes()
        want.append((r.doc_id, at, len(ids) // 4, zlib.crc32(ids)))
        at += len(ids) // 4
    assert sorted(map(tuple, got), key=lambda r: r[1]) == want


def test_orc_empty_and_lookup(spark, tmp_path):
    path = vocabulary("word_bpe_49k.json")
    assert token_orc.round_trip(rows_of(spark).limit(0), path).collect() == []
    token_orc.write_tokens(spark.range(5000).selectExpr("id as doc_id", "concat('text ', id) as text"), str(tmp_path / "o"), path, partitions=3)
    found = token_orc.read_tokens(spark, str(tmp_path / "o"), [17])
    assert "PushedFilters: [In(doc_id" in found._jdf.queryExecution().toString() or "EqualTo(doc_id" in found._jdf.queryExecution().toString()
    assert [r.doc_id for r in found.collect()] == [17]
    from pyarrow import orc

    f = orc.ORCFile(next((tmp_path / "o").glob("*.orc")))
    assert f.row_index_stride == 1000 and f.nrows > 0


def test_orc_streams(spark, tmp_path):
    """What the stripes of a file hold, by its own footers: row indexes, Bloom filters on doc_id alone, run-length encoded integers."""
    token_orc.write_tokens(spark.range(3000).selectExpr("id as doc_id", "concat('text ', id) as text"), str(tmp_path / "o"), vocabulary("word_bpe_49k.json"), partitions=1)
    jvm = spark._jvm
    path = jvm.org.apache.hadoop.fs.Path(str(next((tmp_path / "o").glob("*.orc"))))
    reader = jvm.org.apache.orc.OrcFile.createReader(path, jvm.org.apache.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration()))
    doc_id = 1 + list(reader.getSchema().getFieldNames()).index("doc_id")
    rows, stripes = reader.rows(), 0
    for stripe in reader.getStripes():
        footer = rows.readStripeFooter(stripe)
        found = {}
        for k in range(footer.getStreamsCount()):
            found.setdefault(footer.getStreams(k).getColumn(), set()).add(str(footer.getStreams(k).getKind()))
        assert {"BLOOM_FILTER_UTF8", "ROW_INDEX"} <= found[doc_id] and all("ROW_INDEX" in kinds for kinds in found.values())
        assert not any("BLOOM_FILTER_UTF8" in kinds for column, kinds in found.items() if column != doc_id)
        assert str(footer.getColumns(doc_id).getKind()) == "DIRECT_V2"
        stripes += 1
    rows.close()
    assert stripes and reader.getNumberOfRows() == 3000


def test_cut():
    for n in [1, 2, 31, 682, 683, 1023, 1024, 1025, 2047, 2048, 2049, 9999, *range(1, 3000, 37)]:
        out = packing.cut(n)
        assert sum(x[1] for x in out) == n and [x[0] for x in out] == list(np.cumsum([0, *[x[1] for x in out]])[:-1])
        assert all(length <= 2048 // k for _, length, k in out)


def test_packing(spark):
    path = vocabulary("byte_bpe_50k.json")
    docs = rows_of(spark)
    got = packing.pack(docs, path).collect()
    by_seq = {}
    for r in got:
        by_seq.setdefault(r.sequence_id, []).append(r)
    for rows in by_seq.values():
        rows.sort(key=lambda r: r.offset)
        assert [r.offset for r in rows] == list(np.cumsum([0, *[r.length for r in rows]])[:-1])
        assert sum(r.length for r in rows) <= 2048
    want = sorted(len(whole(path, r.text or "")) // 4 + 1 for r in docs.collect())
    assert sorted(r.doc_tokens for r in got if r.start == 0) == want
    assert sum(r.length for r in got) == sum(want)
    long = next(r.doc_id for r in docs.collect() if r.text and r.text.startswith("word word"))
    ids = whole(path, "word " * 9000) + np.array([1], "<u4").tobytes()
    mine = sorted((r for r in got if r.doc_id == long and r.doc_tokens == len(ids) // 4), key=lambda r: r.start)
    assert [r.ids_crc32 for r in mine] == [zlib.crc32(ids[4 * r.start : 4 * (r.start + r.length)]) for r in mine]
    assert packing.pack(docs.limit(0), path).collect() == []


def test_little_padding(spark):
    docs = spark.range(3000).selectExpr("id as doc_id", "repeat('word ', cast(pow(id % 97, 2) as int)) as text")
    got = packing.pack(docs, vocabulary("byte_bpe_50k.json"))
    n, seqs = got.selectExpr("sum(length)", "count(distinct sequence_id)").first()
    assert n / (seqs * 2048) > 0.95


def test_rest_is_packed_together(spark):
    """Of few documents too the sequences are full: what is left of the classes shares them."""
    got = packing.pack(spark.read.parquet("/root/testdata/sf0.01/documents.parquet"), vocabulary("byte_bpe_50k.json"))
    n, seqs, last = got.selectExpr("sum(length)", "count(distinct sequence_id)", "max(sequence_id)").first()
    assert n / (seqs * 2048) > 0.95 and last == seqs - 1
    spans = {}
    for r in got.select("sequence_id", "offset", "length").collect():
        spans.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for parts in spans.values():
        parts.sort()
        assert [at for at, _ in parts] == [sum(x for _, x in parts[:i]) for i in range(len(parts))] and sum(x for _, x in parts) <= 2048


def test_first_fit():
    lengths = np.array([5, 3, 9, 1, 7, 2, 10, 4])
    bins = packing.first_fit(lengths, 10)
    assert max(lengths[bins == b].sum() for b in set(bins)) <= 10 and len(set(bins)) == 5 and bins.max() == 4
    assert len(packing.first_fit(np.array([], int))) == 0
    # Fewer than k pieces of each class k: the rest is bounded whatever the input.
    classes = {k for n in range(1, 2049) for _, _, k in packing.cut(n)}
    assert sum(k - 1 for k in classes) < 20000
