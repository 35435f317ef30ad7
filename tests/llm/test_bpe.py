"""Byte-level BPE against the tiktoken library and as an exact round trip."""

import hashlib
import random
from pathlib import Path

import public_tokenizers
import pytest
import tiktoken

from playbill.llm import bpe

DATA = Path(public_tokenizers.path("byte_bpe_50k.tiktoken")).read_bytes()
RANKS = bpe.read_ranks(DATA)
ALPHABET = ["a", "B", "é", "漢", " ", "\n", "\t", "'s", "'", "1", "٣", "😀", "‍", "#", "ß", "the", "ing", "  ", "Ж"]


@pytest.fixture(scope="module")
def tiktoken_encoding():
    return tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks=RANKS, special_tokens={})


def texts(n, seed):
    draw = random.Random(seed)
    return ["".join(draw.choice(ALPHABET) for _ in range(draw.randint(0, 40))) for _ in range(n)]


@pytest.mark.parametrize("max_states", [250_000, 20])
def test_encodes_as_tiktoken(tiktoken_encoding, max_states):
    """Also when the states are dropped again and again."""
    codec = bpe.Codec(DATA, public_tokenizers.PATTERN)
    codec.machine.max_states = max_states
    for text in texts(1500 if max_states > 100 else 100, 7):
        ids = codec.encode(text)
        assert ids == tiktoken_encoding.encode_ordinary(text)
        assert codec.decoder.text(ids) == text


def test_long_pieces(tiktoken_encoding):
    codec = bpe.Codec(DATA, public_tokenizers.PATTERN, max_pieces=3)
    draw = random.Random(3)
    for text in ("a" * 30_000, " " * 20_000 + "x", "".join(draw.choice("abcdefgh") for _ in range(30_000)), "<|endoftext|>"):
        assert codec.encode(text) == tiktoken_encoding.encode_ordinary(text)


def test_decoder_takes_any_cut(tiktoken_encoding):
    decoder = bpe.Decoder({rank: token for token, rank in RANKS.items()}, max_moves=50)
    draw = random.Random(5)
    for _ in range(500):
        ids = [draw.randrange(len(RANKS)) for _ in range(draw.randint(0, 12))]
        expected = tiktoken_encoding.decode_bytes(ids).decode("utf-8", "replace")
        assert decoder.text(ids) == expected
        out, state = [], b""
        for token in ids:
            piece, state = decoder.stream([token], state)
            out.append(piece)
        assert "".join(out) + "�" * bool(state) == expected


def test_rows(spark, docs_of, tiktoken_encoding):
    rows = [(1, None), (2, ""), (3, "The same."), (3, "The same."), (None, "no id"), (5, "long " * 20_000), (6, "漢字 😀")]
    df = docs_of(rows)
    got = bpe.encoded(df, DATA, public_tokenizers.PATTERN).collect()
    assert len(got) == len(rows) and all(r.round_trip for r in got)
    by_id = {r.doc_id: r for r in got}
    for i, text in rows:
        ids = tiktoken_encoding.encode_ordinary(text or "")
        assert by_id[i].ids == ids and by_id[i].n_tokens == len(ids)
        assert by_id[i].ids_sha256 == hashlib.sha256(" ".join(map(str, ids)).encode()).hexdigest()
        assert by_id[i].decoded_sha256 == hashlib.sha256((text or "").encode()).hexdigest()
    back = {r.doc_id: r.text for r in bpe.decoded(bpe.encoded(df, DATA, public_tokenizers.PATTERN), DATA).collect()}
    assert back == {i: text or "" for i, text in rows}
    assert bpe.encoded(df.limit(0), DATA, public_tokenizers.PATTERN).count() == 0


def test_worker_memory_is_bounded(spark):
    """A million different noise words: with small limits a worker stays under 200 MB."""
    import subprocess
    import sys

    code = """
import random, resource, sys
sys.path.insert(0, %r)
from pathlib import Path
import public_tokenizers
from playbill.llm import bpe
own = bpe.codec(Path(public_tokenizers.path("byte_bpe_50k.tiktoken")).read_bytes(), public_tokenizers.PATTERN, 45_000, 80_000)
rng = random.Random(1)
for _ in range(1000):
    text = " ".join("".join(rng.choices("abcdefghijklmnopqrstuvwxyz0123456789", k=rng.randrange(5, 12))) for _ in range(1000))
    own.decoder.text(own.encode(text))
print(resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)
"""
    root = str(Path(__file__).resolve().parents[2])
    out = subprocess.run([sys.executable, "-c", code % root], capture_output=True, text=True, check=True)
    assert int(out.stdout) < 200, out.stdout


def test_batches_are_cut_by_size():
    import pyarrow as pa

    from playbill.llm.common import of_size

    batch = pa.RecordBatch.from_arrays([pa.array(range(6)), pa.array(["a" * 10, None, "", "b" * 500, "c" * 30, "d" * 80])], ["i", "t"])
    assert [len(b) for b in of_size(iter([batch]), 1, 4, 100)] == [3, 1, 1, 1]
    assert [len(b) for b in of_size(iter([batch.slice(2)]), 1, 2, 1000)] == [2, 2]
