"""Token ids, token files and packing against whole-text encoding and exact round trips."""

import random
import zlib
from collections import defaultdict

import numpy as np
import pyarrow as pa
import pytest

from packshot.llm import arrow_text, best_fit_packing, token_output
from packshot.llm.queries import tokenizer_file
from packshot.llm.tokenize import PieceEncoder


@pytest.fixture(scope="module")
def encoder():
    return PieceEncoder(tokenizer_file())


def ids_of(encoder, texts):
    ids, counts = encoder.encode(*arrow_text.buffer(pa.array(texts, pa.string())))
    return [x.tolist() for x in np.split(ids, np.cumsum(counts)[:-1])] if texts else []


@pytest.mark.parametrize("seed", range(5))
def test_pieces_give_the_ids_of_whole_texts(encoder, seed):
    random.seed(seed)
    letters = list("ab Z9.,'-|  \n\n\té“ñ ſs'tlre中\x00<>\u00a0\u3000")
    texts = ["".join(random.choice(letters) for _ in range(random.randint(0, 40))) for _ in range(300)]
    assert ids_of(encoder, texts) == encoder.whole(texts)


def test_pieces_survive_a_forgotten_table(encoder):
    texts = ["the of and to", "it's 'tis x'll", "<|endoftext|>", "", "a  b\n\nc"]
    before = ids_of(encoder, texts)
    encoder.forget()
    assert ids_of(encoder, texts) == before == encoder.whole(texts)


def test_special_strings_get_the_ids_of_the_plain_library(encoder):
    from tokenizers import Tokenizer

    plain = Tokenizer.from_file(tokenizer_file())
    random.seed(1)
    parts = ["<|endoftext|>", "<|endoftext|", "<|endof", "text|>", "a", " ", "b", "\n", "'s", "|", "é"]
    texts = ["a <|endoftext|> b", "<|endoftext|>", " <|endoftext|>", "<|endof", "text|>", "of the"]
    texts += ["".join(random.choice(parts) for _ in range(random.randint(0, 12))) for _ in range(500)]
    want = [plain.encode(t, add_special_tokens=False).ids for t in texts]
    assert want[0] == [64, 220, 50256, 275]
    assert ids_of(encoder, texts) == want
    encoder.forget()
    assert [ids_of(encoder, [t])[0] for t in texts] == want


@pytest.mark.parametrize("bits", [1, 8])
@pytest.mark.parametrize("n", [0, 1, 7, 64, 1000, 4097])
def test_file_round_trip(bits, n):
    ids = np.random.default_rng(n).integers(0, 2**32, n, dtype=np.uint32)
    docs, counts = np.array([5, 9]), np.array([n // 3, n - n // 3])
    got = token_output.unpack_file(token_output.pack_file(docs, counts, ids, 1000, bits))
    assert all((a == b).all() for a, b in zip(got, (docs, counts, ids), strict=True))


def test_other_content_is_refused():
    with pytest.raises(ValueError):
        token_output.unpack_file(b"x" * 200)


def expected(encoder, rows):
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1] is not None, r[1] or ""))
    out, start = [], 0
    for doc, text in rows:
        ids = np.array([*encoder.whole([text or ""])[0], 2], "<u4")
        out.append((doc, start, len(ids), zlib.crc32(ids.tobytes())))
        start += len(ids)
    return out


def test_token_files(spark, documents, odd_rows, encoder, tmp_path):
    rows = odd_rows + [(i, f"text {i} " * (i % 9)) for i in range(100, 140)]
    files = token_output.write_token_files(documents(rows, extra=True), str(tmp_path / "f"), tokenizer_file(), ids_per_file=5000, bits=1)
    got = [tuple(r) for r in token_output.read_token_files(files).collect()]
    key = lambda r: (r[0] is not None, r[0] or 0, r[1])
    assert sorted(got, key=key) == sorted(expected(encoder, rows), key=key)
    assert files.count() >= 2  # the long text fills one


def test_token_files_of_nothing(spark, documents, tmp_path):
    files = token_output.write_token_files(documents([]), str(tmp_path / "f"), tokenizer_file())
    assert token_output.read_token_files(files).count() == 0


def check_packing(rows, capacity):
    by_sequence = defaultdict(list)
    for r in rows:
        by_sequence[r["sequence_id"]].append((r["offset"], r["length"]))
    for places in by_sequence.values():
        at = 0
        for offset, length in sorted(places):
            assert offset == at
            at += length
        assert at <= capacity
    return len(by_sequence)


def test_packing(spark, documents, odd_rows, encoder):
    rows = odd_rows + [(i, "of the and " * (i * 7 % 130)) for i in range(100, 180)]
    got = best_fit_packing.packed_documents(documents(rows, extra=True), tokenizer_file(), capacity=128).collect()
    assert check_packing(got, 128) <= 1.05 * sum(r["length"] for r in got) / 128 + 2
    want = defaultdict(list)
    for doc, text in rows:
        ids = np.array([*encoder.whole([text or ""])[0], 2], "<u4")
        head = len(ids) % 128 or min(128, len(ids))
        cuts = [0, *range(head, len(ids) + 1, 128)]
        want[doc] += [(p, a, b - a, zlib.crc32(ids[a:b].tobytes())) for p, (a, b) in enumerate(zip(cuts[:-1], cuts[1:], strict=True))]
    found = defaultdict(list)
    for r in got:
        found[r["doc_id"]].append((r["piece"], r["start"], r["length"], r["ids_crc32"]))
    assert {k: sorted(v) for k, v in found.items()} == {k: sorted(v) for k, v in want.items()}


def test_packing_of_nothing(spark, documents):
    assert best_fit_packing.packed_documents(documents([]), tokenizer_file()).count() == 0


@pytest.mark.parametrize("seed", range(6))
def test_plan_uses_every_piece_and_few_sequences(seed):
    rng = np.random.default_rng(seed)
    lengths = rng.integers(1, 1025, 3000) if seed % 2 else np.minimum(1024, 1 + rng.exponential(200, 3000).astype(int))
    counts = np.bincount(lengths, minlength=1025)
    templates = best_fit_packing.plan(counts)
    used = np.zeros(1025, int)
    for parts, times in templates:
        assert sum(parts) <= 1024
        for n in parts:
            used[n] += times
    assert (used == counts).all()
    least = max(-(-lengths.sum() // 1024), (lengths > 512).sum())
    assert sum(t for _, t in templates) <= 1.03 * least + 2


def test_one_length_for_all():
    counts = np.zeros(1025, int)
    counts[300] = 10_001
    assert sum(t for _, t in best_fit_packing.plan(counts)) == -(-10_001 // 3)
