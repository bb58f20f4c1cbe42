"""Token files: exact round trip, order, file layout and pruning."""

import zlib

import numpy as np
import pyarrow as pa
import public_tokenizers
import pytest
from conftest import SF
from hypothesis import given, settings, strategies as st
from pyarrow import orc
from tokenizers import Tokenizer

from corpus import awkward, none
from ledgerloom.llm import tokens as tk
from ledgerloom.llm.common import table
from ledgerloom.llm.queries_text import op2_token_orc

PATH = public_tokenizers.path("word_bpe_49k.json")
WHOLE = Tokenizer.from_file(PATH)
BY_WORD = tk.TextEncoder(PATH)


def ids(encoder, text):
    return np.frombuffer(encoder.encode(text.encode()), "<u4").tolist()


@settings(deadline=None, max_examples=300)
@given(st.text(alphabet="aAbZéÉßİıſKÅ'sStTlLdD.,;:!?<|>0९ \t\n\x0b\x85  ̇́ñ中\U0001F600-_/&\x1cǅŉªº", max_size=40))
def test_word_by_word_equals_whole_texts(text):
    for one in (text, text + " <|endoftext|>. don't I'LL"):
        assert ids(BY_WORD, one) == WHOLE.encode(one, add_special_tokens=False).ids


def test_forgetting_words_changes_nothing():
    text = " ".join(f"wort{i}, " for i in range(300))
    assert ids(tk.TextEncoder(PATH, remembered=3), text) == ids(BY_WORD, text)


def test_other_tokenizers_get_whole_texts():
    path = public_tokenizers.path("byte_bpe_50k.json")
    text = "Two  spaces\nand 'quotes' they'll é"
    assert ids(tk.TextEncoder(path), text) == Tokenizer.from_file(path).encode(text, add_special_tokens=False).ids


def test_digests(spark):
    rows = sorted((r.doc_id, r.text) for r in table(spark, SF, "documents").collect())
    found = {r.doc_id: (r.start, r.n_tokens, r.ids_crc32) for r in op2_token_orc(spark, SF).collect()}
    start = 0
    for i, text in rows:
        own = [*WHOLE.encode(text, add_special_tokens=False).ids, 2]
        assert found[i] == (start, len(own), zlib.crc32(np.array(own, "<u4").tobytes()))
        start += len(own)


def has_bloom_filter(spark, file):
    jvm = spark._jvm.org.apache
    reader = jvm.orc.OrcFile.createReader(
        jvm.hadoop.fs.Path(file), jvm.orc.OrcFile.readerOptions(spark._jsc.hadoopConfiguration()))
    column = reader.getSchema().findSubtype("doc_id").getId()
    footer = reader.rows().readStripeFooter(reader.getStripes()[0])
    kinds = {(s.getColumn(), s.getKind().toString()) for s in footer.getStreamsList()}
    return {(column, "ROW_INDEX"), (column, "BLOOM_FILTER_UTF8")} <= kinds


def test_files(spark, tmp_path):
    path = str(tmp_path / "ids")
    tk.write_tokens(table(spark, SF, "documents"), path, PATH)
    last = -1
    for file in sorted((tmp_path / "ids").glob("*.orc")):
        held = orc.ORCFile(file)
        assert held.row_index_stride == tk.INDEX_ROWS and has_bloom_filter(spark, str(file))
        found = held.read(columns=["doc_id"])["doc_id"].to_pylist()
        assert found == sorted(found) and found[0] > last
        last = found[-1]
    some = tk.read_tokens(spark, path, first=10, last=20)
    assert sorted(r.doc_id for r in some.collect()) == list(range(10, 21))
    plan = some._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(doc_id,10)" in plan and "LessThanOrEqual(doc_id,20)" in plan
    assert [r.doc_id for r in tk.read_tokens(spark, path, only=[33]).collect()] == [33]


def test_awkward_rows(spark, tmp_path):
    path = str(tmp_path / "ids")
    docs = awkward(spark)
    tk.write_tokens(docs, path, PATH)
    found = tk.token_digests(spark, path).orderBy("start").collect()
    assert [r.doc_id for r in found] == [None, 1, 2, 3, 4, 5, 6, 7, 8, 9, 10, 10, 11, 12]
    ends = [r.start + r.n_tokens for r in found]
    assert [r.start for r in found] == [0, *ends[:-1]]
    empty = zlib.crc32(np.array([2], "<u4").tobytes())
    assert {r.doc_id for r in found if (r.n_tokens, r.ids_crc32) == (1, empty)} == {1, 2, 8, 11}
    text = docs.where("doc_id = 5").first().text
    assert [r.n_tokens for r in found if r.doc_id == 5] == [len(WHOLE.encode(text, add_special_tokens=False).ids) + 1]
    tk.write_tokens(none(spark), path + "0", PATH)
    assert tk.token_digests(spark, path + "0").count() == 0


def test_a_word_is_encoded_once_whatever_its_case_and_punctuation():
    encoder, asked = tk.TextEncoder(PATH), []
    split, whole = encoder._split, encoder._whole
    encoder._split = lambda letters: asked.append(letters) or split(letters)
    encoder._whole = lambda text: asked.append(text) or whole(text)
    texts = ["Heute HEUTE heute### heute%%%", None, "", " heute&&&\theute.$$$ Heute, \x85heute", "ÄHRE ähre."]
    found = encoder.encode_all(pa.array(texts))
    assert [np.frombuffer(f, "<u4").tolist() for f in found] == [WHOLE.encode(t or "", add_special_tokens=False).ids for t in texts]
    assert sorted(a for a in asked if a.endswith("hre") or "heute" in a) == sorted(["heute", "\x85heute", "ähre".encode().decode("latin-1")])
