"""The encoder, BPE, token files and packing against the tokenizers library."""

import hashlib
import itertools
import json
import os
import random
import tempfile
import zlib

import numpy as np
import pytest
from tokenizers import Tokenizer

from cases import EDGE, SF0001, documents, edge_table, empty_table
from feedlens.llm import bpe, common, orc_tokens, packing, queries, tokens
from feedlens.llm.tokens import DocumentEncoder, default_tokenizer

ALPHABET = "aaab  e\té\n'stLl.!12½ 　日本\x1c\x85\xa0ß\U0001f600" + chr(0x301)


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(default_tokenizer())


@pytest.fixture(scope="module")
def codec():
    return bpe.Codec(default_tokenizer())


def _texts(n=1500, seed=3):
    rng = random.Random(seed)
    return ["".join(rng.choices(ALPHABET, k=rng.randint(0, 50))) for _ in range(n)] + [
        "", "a<|endoftext|>b <|endoftext|>", " a" * 3000, "I'm we're THE'S they'll", "a" * 5000, "<|endoftext", "\r\n\r\n x"]


def _ids(library, text):
    return library.encode(text or "", add_special_tokens=False).ids


def _raw(ids):
    return np.array(ids, "<u4").tobytes()


def test_encoder_equals_the_library(library):
    own, texts = DocumentEncoder(default_tokenizer()), _texts()
    assert own.by_word
    assert own.encode(texts) == [_raw(_ids(library, t)) for t in texts]


def test_words_forgotten_are_learnt_again(library, monkeypatch):
    from feedlens.llm import tokens
    monkeypatch.setattr(tokens, "CACHE_WORDS", 40)
    monkeypatch.setattr(bpe, "CACHE_WORDS", 40)
    texts = _texts(200)
    for own in (DocumentEncoder(default_tokenizer()), bpe.Codec(default_tokenizer())):
        for part in (texts[:100], texts[100:], texts[:100]):
            assert own.encode(part) == [_raw(_ids(library, t)) for t in part]
        assert len(own.known) + len(own.older) < 5000


def test_other_tokenizers_go_through_the_library():
    import public_tokenizers
    path = public_tokenizers.path("word_bpe_49k.json")
    own, library = DocumentEncoder(path), Tokenizer.from_file(path)
    assert not own.by_word
    assert own.encode(["Some words, 12.", ""]) == [_raw(_ids(library, "Some words, 12.")), _raw(_ids(library, ""))]
    with pytest.raises(ValueError, match="byte-level"):
        bpe.Codec(path)


def test_speculative_bpe_equals_the_library(library, codec):
    texts = _texts(seed=8)
    assert codec.encode(texts) == [_raw(_ids(library, t)) for t in texts]
    assert 0 < codec.failed < codec.seen  # both ways were taken
    for t in texts:
        ids = _ids(library, t)
        assert codec.decode(ids) == library.decode(ids, skip_special_tokens=False)


def test_pairs_are_compatible_if_merging_keeps_their_border(codec):
    rng = np.random.default_rng(2)
    a, b = rng.integers(0, 50256, 4000), rng.integers(0, 50256, 4000)
    a[:1500], b[:1500] = rng.integers(0, 600, 1500), rng.integers(0, 600, 1500)
    own = (codec.self_encoded(a) & codec.self_encoded(b))
    want = np.array([codec.merge(codec.tokens[x] + codec.tokens[y]) == [x, y] for x, y in zip(a.tolist(), b.tolist())])
    got = codec.compatible(a, b)
    assert (got[own] == want[own]).all() and 0 < want.sum() < len(want)


def _codes(text):
    return hashlib.sha256(text.encode()).hexdigest()


def _check_digests(got, rows, library):
    want = sorted(((i is None, i or 0), len(ids), _codes(",".join(map(str, ids))),
                   _codes(library.decode(ids, skip_special_tokens=False)))
                  for i, ids in ((i, _ids(library, t)) for i, t in rows))
    assert sorted(((r.doc_id is None, r.doc_id or 0), r.n_tokens, r.ids_sha256, r.decoded_sha256) for r in got) == want


def test_bpe_defined_cases(spark, library):
    _check_digests(bpe.round_trip_digests(edge_table(spark)).collect(), EDGE, library)
    assert bpe.round_trip_digests(empty_table(spark)).count() == 0
    encoded = bpe.encode(edge_table(spark))
    texts = sorted((t or "") for _, t in EDGE)
    assert sorted(r.text for r in bpe.decode(encoded).collect()) == texts


def test_many_added_tokens_in_a_text(spark, library):
    """A dump of joined documents: far more added tokens than Python lets functions nest."""
    rows = [(1, "a story<|endoftext|>" * 100_000), (2, "<|endoftext|>" * 5000), (3, "<|endoftext|> x<|endoftext|")]
    _check_digests(bpe.round_trip_digests(documents(spark, rows)).collect(), rows, library)


def test_longest_of_added_tokens_at_a_place():
    with open(default_tokenizer(), encoding="utf-8") as f:
        spec = json.load(f)
    spec["added_tokens"] += [{"content": "<|end", "id": 60000}, {"content": "<|endoftext|>.", "id": 60001}]
    path = os.path.join(tempfile.mkdtemp(prefix="feedlens-test-"), "tokenizer.json")
    with open(path, "w", encoding="utf-8") as f:
        json.dump(spec, f)
    own = bpe.Codec(path)
    eot = own.added["<|endoftext|>"]
    assert own.pieces("a b<|endoftext|><|endoftext|>.<|end.") == ["a", " b", eot, 60001, 60000, "."]


def test_bpe_query(spark, library):
    rows = [(r.doc_id, r.text) for r in common.documents(spark, SF0001).collect()]
    _check_digests(queries.QUERIES["op10_speculative_bpe"](spark, SF0001).collect(), rows, library)


def _check_file(got, rows, library):
    order = sorted(rows, key=lambda r: (r[0] is None, r[0] or 0, r[1] or ""))
    at, want = 0, []
    for i, t in order:
        ids = [*_ids(library, t), 0]
        want.append((i, at, len(ids), zlib.crc32(_raw(ids))))
        at += len(ids)
    assert sorted((tuple(r) for r in got), key=lambda r: r[1]) == want


def test_token_file_defined_cases(spark, library, tmp_dir):
    for parts in (1, 3, 40):
        path = f"{tmp_dir}/tokens-{parts}"
        orc_tokens.write_tokens(edge_table(spark), path, parts=parts)
        _check_file(orc_tokens.token_digests(orc_tokens.read_tokens(spark, path)).collect(), EDGE, library)
    orc_tokens.write_tokens(empty_table(spark), f"{tmp_dir}/empty")
    assert orc_tokens.read_tokens(spark, f"{tmp_dir}/empty").count() == 0


def test_token_file_query(spark, library):
    rows = [(r.doc_id, r.text) for r in common.documents(spark, SF0001).collect()]
    _check_file(queries.QUERIES["op3_orc_tokens"](spark, SF0001).collect(), rows, library)


def test_token_file_layout(spark, tmp_dir):
    """Ids come back as they were, files are ranges of doc_id, and a lookup is pushed to the file's indexes."""
    import glob

    import pyarrow.orc as orc

    rows = [(i, f"document number {i} " * 20) for i in range(2000)]
    path = f"{tmp_dir}/tokens"
    orc_tokens.write_tokens(documents(spark, rows).repartition(4), path, parts=3, index_rows=1000)
    files = sorted(glob.glob(f"{path}/*.orc"))
    spans = sorted((t["doc_id"].to_pylist()[0], t["doc_id"].to_pylist()[-1], t["doc_id"].to_pylist())
                   for t in (orc.read_table(f) for f in files) if t.num_rows)
    assert all(ids == sorted(ids) for *_, ids in spans) and len(spans) == 3
    assert all(a[1] < b[0] for a, b in zip(spans, spans[1:]))
    found = orc_tokens.read_tokens(spark, path).where("doc_id = 777")
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "EqualTo(doc_id,777)" in plan
    own = DocumentEncoder(default_tokenizer())
    assert _raw(found.first().ids) == own.encode([rows[777][1]])[0] + b"\0\0\0\0"


@pytest.mark.parametrize("seed", range(5))
def test_best_fill_is_the_largest_reachable_sum(seed):
    rng = random.Random(seed)
    counts = {rng.randint(1, 30): rng.randint(1, 3) for _ in range(5)}
    for capacity in (1, 17, 64, 100):
        items = [n for n, k in counts.items() for _ in range(k)]
        best = max(sum(c) for r in range(len(items) + 1) for c in itertools.combinations(items, r) if sum(c) <= capacity)
        used = packing.best_fill(counts, capacity)
        assert sum(n * k for n, k in used.items()) == best
        assert all(k <= counts[n] for n, k in used.items())


def _check_packing(rows, texts, library, window=1024):
    ids = {}
    for i, t in texts:
        ids.setdefault(i, []).append([*_ids(library, t), 0])
    pieces, sequences = {}, {}
    for r in rows:
        pieces.setdefault(r.doc_id, []).append(r)
        sequences.setdefault(r.sequence_id, []).append(r)
    assert set(pieces) == set(ids)
    for doc_id, own in pieces.items():
        if len(ids[doc_id]) == 1:
            at = 0
            for r in sorted(own, key=lambda r: r.start):
                assert (r.start, r.doc_tokens) == (at, len(ids[doc_id][0]))
                assert zlib.crc32(_raw(ids[doc_id][0][at:at + r.length])) == r.ids_crc32
                at += r.length
            assert at == len(ids[doc_id][0])
        else:
            assert sum(r.length for r in own) == sum(map(len, ids[doc_id]))
    padding = 0
    for own in sequences.values():
        at = 0
        for r in sorted(own, key=lambda r: r.offset):
            assert r.offset == at
            at += r.length
        assert at <= window
        padding += 0 if at & at - 1 == 0 else window - at
    return padding


def test_packing_defined_cases(spark, library):
    for table in (edge_table(spark), edge_table(spark).repartition(4)):
        assert _check_packing(packing.pack(table).collect(), EDGE, library) == 0
    assert _check_packing(packing.pack(edge_table(spark), window=7, group_tokens=50).collect(), EDGE, library, 7) == 0
    assert packing.pack(empty_table(spark)).count() == 0


def test_packing_query(spark, library):
    rows = [(r.doc_id, r.text) for r in common.documents(spark, SF0001).collect()]
    assert _check_packing(queries.QUERIES["op4_bin_slack_packing"](spark, SF0001).collect(), rows, library) == 0


def test_packing_cuts_few_documents():
    group = packing.Group(1024, itertools.count())
    rng = random.Random(6)
    sizes = [rng.randint(1, 3000) for _ in range(3000)]
    for i, n in enumerate(sizes):
        group.add(i, bytes(4 * n))
    rows = group.pack()
    assert len(rows) - sum(-(-n // 1024) for n in sizes) < 0.15 * len(sizes)


def test_words_of_any_length(library):
    """Merging by heap: equal to the library and to scanning, in time that does not grow with the square."""
    rnd = random.Random(9)
    own = bpe.Codec(default_tokenizer())
    for n, letters in ((1_000_000, "abcdefghijklmnopqrstuvwxyz"), (60_000, "日本語のテキスト文字列"), (80_000, "ab"), (50_000, "=")):
        word = "".join(rnd.choices(letters, k=n))
        assert np.frombuffer(own.encode([word])[0], "<u4").tolist() == library.encode(word, add_special_tokens=False).ids
    assert not own.known and not own.chars  # long words are not kept
    for _ in range(200):
        word = "".join(rnd.choices("abcdeénstr '日", k=rnd.randrange(1, 90))).encode()
        by_scan = own.merge(word) if len(word) <= bpe.SCANNED else None
        by_heap = own.merge_long(word)
        assert by_scan in (None, by_heap)


def test_caches_are_bounded_by_characters(monkeypatch):
    rnd = random.Random(10)
    monkeypatch.setattr(bpe, "CACHE_CHARS", 2000)
    monkeypatch.setattr(tokens, "CACHE_CHARS", 2000)
    texts = [" ".join("".join(rnd.choices("abcdefgh", k=rnd.randrange(1, 200))) for _ in range(20)) for _ in range(60)]
    codec, encoder = bpe.Codec(default_tokenizer()), tokens.DocumentEncoder(tokens.default_tokenizer())
    fresh = bpe.Codec(default_tokenizer())
    for text in texts:
        assert codec.encode([text]) == encoder.encode([text]) == fresh.encode([text])
        for own in (codec, encoder):
            assert sum(map(len, [*own.known, *own.older])) < 2 * (1000 + 20 * tokens.LONG_WORD)
            assert max(map(len, own.known), default=0) <= tokens.LONG_WORD + 1


def test_documents_without_id_are_spread(spark):
    """Half of the rows without id: last, over many files, and offsets without gaps."""
    rows = [(i if i % 2 else None, f"{'abcdefghé日'[i // 2 % 10]} text number {i} " * (i % 5 + 1)) for i in range(800)]
    path = os.path.join(tempfile.mkdtemp(prefix="feedlens-test-"), "t")
    orc_tokens.write_tokens(documents(spark, rows), path, parts=6)
    got = orc_tokens.read_tokens(spark, path).orderBy("start").collect()
    assert len(got) == 800 and [r.doc_id for r in got[:400]] == sorted(i for i, _ in rows if i is not None)
    assert all(a.start + a.n_tokens == b.start for a, b in zip(got, got[1:]))
    per_file = spark.read.orc(path).where("doc_id is null").groupBy("part").count().collect()
    assert len(per_file) == 3 and max(r["count"] for r in per_file) < 250
    _check_file(orc_tokens.token_digests(orc_tokens.read_tokens(spark, path)).collect(), rows, Tokenizer.from_file(default_tokenizer()))
