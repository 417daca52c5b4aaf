"""Operators 1, 6 and 8 against the tokenizers library."""

import hashlib
import random
import zlib

import numpy as np
import pytest
from conftest_llm import BYTE_BPE, EDGE
from tokenizers import Tokenizer

from quayside.llm import bpe_automaton, token_counts, token_files
from quayside.llm.vocab import load_byte_bpe


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(BYTE_BPE)


def ids_of(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def packed(ids):
    return np.array(ids, "<u4").tobytes()


PIECES = ["a", "aa", "the", " ", "  ", "   ", "\n", "\t", "\x1c", "\x85", " ", " ", "'s", "'re", "'", "''", "1", "23", "é", "ß", "中", "😀",
          "<|endoftext|>", "<|endof", "!", "?!", "\r\n", "́", "x" * 9, "\x00", "ſ", "²", "Ⅷ", "١", "ABC"]


@pytest.fixture(scope="module")
def texts():
    rng = random.Random(5)
    mixed = ["".join(rng.choices(PIECES, k=rng.randint(0, 14))) for _ in range(3000)]
    words = ["".join(rng.choices("abeinorst", k=rng.randint(1, 30))) for _ in range(3000)]
    return mixed + words + ["a" * n for n in range(150)] + ["ab" * 20_000] + [t or "" for _, t, _, _ in EDGE]


def test_texts_encode_as_the_library_does(library, texts):
    want = [packed(ids_of(library, t)) for t in texts]
    assert bpe_automaton.encode_texts(BYTE_BPE, texts) == want
    assert token_files.library_ids(BYTE_BPE, texts) == want
    assert token_counts.count_tokens(BYTE_BPE, texts) == [len(w) // 4 for w in want]
    for t, w in zip(texts, want):
        assert bpe_automaton.decode_ids(BYTE_BPE, w) == library.decode(ids_of(library, t), skip_special_tokens=False)


def test_automaton_arcs_agree_with_the_chain_they_index(library):
    machine = bpe_automaton.MergeAutomaton(load_byte_bpe(BYTE_BPE))
    rng = random.Random(1)
    for _ in range(20_000):
        state, token = rng.randrange(len(machine.parent)), rng.randrange(50_256)
        assert machine.has_arc(state, token) == machine._built_arc(state, token)


def test_table_limit_does_not_change_results(library, texts):
    machine = bpe_automaton.MergeAutomaton(load_byte_bpe(BYTE_BPE), table_limit=50)
    words = [w.encode() for w in ["the", "thing", "tttthe", "q" * 3000, ""]] * 3
    for w, got in zip(words, machine.encode_words(words)):
        assert got == packed(ids_of(library, w.decode()))


def test_round_trip_of_tables(library, docs, edge, none):
    for df in (docs, edge):
        want = sorted((str(r.doc_id), len(i := ids_of(library, r.text)), hashlib.sha256(packed(i)).hexdigest(), hashlib.sha256((r.text or "").encode()).hexdigest())
                      for r in df.select("doc_id", "text").collect())
        got = bpe_automaton.bpe_round_trip(df, BYTE_BPE).collect()
        assert sorted((str(r.doc_id), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want
    assert bpe_automaton.bpe_round_trip(none, BYTE_BPE).count() == 0
    rows = bpe_automaton.bpe_encode(edge, BYTE_BPE).collect()
    assert sorted((str(r.doc_id), bytes(r.ids)) for r in rows) == sorted((str(r.doc_id), packed(ids_of(library, r.text))) for r in edge.collect())


def test_token_counts_of_tables(library, docs, edge, none):
    for df in (docs, edge):
        want = sorted((str(r.doc_id), len((r.text or "").encode()), n := len(ids_of(library, r.text)), n > 1024) for r in df.select("doc_id", "text").collect())
        assert sorted((str(r.doc_id), r.n_bytes, r.n_tokens, r.over_limit) for r in token_counts.token_counts(df, BYTE_BPE, 1024).collect()) == want
    assert token_counts.token_counts(none, BYTE_BPE, 1024).count() == 0


@pytest.mark.parametrize("n", [0, 1, 7, 511, 512, 513, 5000])
@pytest.mark.parametrize("most", [200, 50_257, 2**32 - 1])
def test_codes_give_any_stretch(n, most):
    rng = np.random.default_rng(n)
    ids = rng.integers(0, most, n, dtype=np.uint32)
    reader = token_files.DacReader(token_files.dac_encode(ids))
    assert len(reader) == n
    for _ in range(30):
        a, b = sorted(rng.integers(0, n + 1, 2).tolist())
        assert (reader.read(a, b) == ids[a:b]).all()
    for i in range(0, n, 37):
        assert reader[i] == ids[i]
    with pytest.raises(IndexError):
        reader[n]


def test_token_files_read_back(spark, library, docs, edge, none, tmp_dir):
    for k, df in enumerate((docs, edge, none)):
        token_files.write_token_files(df, BYTE_BPE, f"{tmp_dir}/{k}", end_id=2, segment_tokens=5_000)
        rows = sorted(df.select("doc_id", "text").collect(), key=lambda r: (r.doc_id is not None, r.doc_id or 0, r.text is not None, r.text or ""))
        want, start = [], 0
        for r in rows:
            ids = [*ids_of(library, r.text), 2]
            want.append((r.doc_id, start, len(ids), zlib.crc32(packed(ids))))
            start += len(ids)
        got = token_files.read_documents(spark, f"{tmp_dir}/{k}").collect()
        assert sorted(((r.doc_id, r.start, r.n_tokens, r.ids_crc32) for r in got), key=lambda x: x[1]) == want
