"""op2, op6, op7 and op9 against their libraries and brute force, with odd inputs."""
import hashlib
import math
import random
import re

import public_tokenizers
import pytest

ODD = [None, "", " ", "  ", "\n", "a", "a b", "a  b ", " lead", "tab\tx\ry\x0bz", "▁a▁ b", "<s></s><unk> <|endoftext|>", "é中😀​　x\xa0y",
       "word " * 30_000, "x" * 100_000, "a" + " " * 20_000 + "b", "\n\n a\n \nb", "don't we'll  \t end  ", "same", "same"]


@pytest.fixture(scope="module")
def odd(spark):
    rng = random.Random(5)
    made = ["".join(rng.choice(" ▁\n\t\réé中ab<s>0x;)'t😀") for _ in range(rng.randint(0, 60))) for _ in range(300)]
    return [(i, t, "keep", i * 2) for i, t in enumerate(ODD + made)] + [(None, "no id", "keep", 0), (3, " ", "keep", 1)]


def frame(spark, rows, names="doc_id long, text string, n_tokens string, n_chars long"):
    return spark.createDataFrame(rows, names).repartition(3)


def test_token_counts_equal_the_library(spark, odd):
    import sentencepiece

    from riskmart.llm.token_counts import MODEL, token_counts
    path = public_tokenizers.path(MODEL)
    sp = sentencepiece.SentencePieceProcessor(model_file=path)
    got = token_counts(frame(spark, odd).withColumnRenamed("n_tokens", "N_BYTES"), path, max_entries=50, per_task=20)
    rows = got.collect()
    assert len(rows) == len(odd) and set(got.columns) == {"doc_id", "n_chars", "n_bytes", "n_tokens", "over_limit"}
    want = sorted((-1 if d is None else d, c, len((t or "").encode()), len(sp.encode(t or "")), len(sp.encode(t or "")) > 4096) for d, t, _, c in odd)
    assert sorted((-1 if r.doc_id is None else r.doc_id, r.n_chars, r.n_bytes, r.n_tokens, r.over_limit) for r in rows) == want
    assert token_counts(frame(spark, []), path).count() == 0


def test_worker_cache_keeps_counts_when_it_turns_over(monkeypatch):
    from riskmart.llm import token_counts as T
    sp = T.load_model(public_tokenizers.path(T.MODEL))
    monkeypatch.setattr(T, "MAX_CACHE", 5)
    lengths = T.Lengths(sp, {})
    for text in ("one two three four five six seven eight", "eight seven nine ten one two", "x\ny z") * 3:
        assert T.count_tokens(lengths, text) == len(sp.encode(text))


def test_bpe_equals_the_library_and_round_trips(spark, odd):
    from riskmart.llm.bpe import RANKS, bpe_round_trip, load_encoding, parts
    enc = load_encoding(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    got = bpe_round_trip(frame(spark, odd), public_tokenizers.path(RANKS), public_tokenizers.PATTERN, with_ids=True, decoded=True)
    by = {}
    for r in got.collect():
        by.setdefault((r.doc_id, r.decoded_text), []).append(r)
    for d, t, *_ in odd:
        t = t or ""
        for r in by[d, t]:
            ids = enc.encode_ordinary(t)
            assert list(r.ids) == ids and r.n_tokens == len(ids)
            assert r.ids_sha256 == hashlib.sha256(b"".join(i.to_bytes(4, "little") for i in ids)).hexdigest()
            assert r.decoded_sha256 == hashlib.sha256(t.encode()).hexdigest()
    for t in ODD[:-4]:
        cut = list(parts(t or "", 7))
        assert "".join(cut) == (t or "")
        assert [i for p in cut for i in enc.encode_ordinary(p)] == enc.encode_ordinary(t or "")
    assert bpe_round_trip(frame(spark, []), public_tokenizers.path(RANKS), public_tokenizers.PATTERN).count() == 0


def test_bpe_white_space_too_long_for_the_library(spark):
    from riskmart.llm.bpe import RANKS, encode, load_encoding
    enc = load_encoding(public_tokenizers.path(RANKS), public_tokenizers.PATTERN)
    for n in (12_000, 60_000):
        for t in ("a" + " " * n + "b", " \t" * n, "x" + "\n" * n + " y z", " " * n):
            assert encode(enc, t).tolist() == enc.encode_ordinary(t)
    t = "a" + " " * 2_000_000 + "b c"
    assert enc.decode(encode(enc, t).tolist()) == t


def omh_brute(text, sketch):
    """Order MinHash by sorting all numbered k-mers, with the operator's own hashes."""
    import numpy as np

    from riskmart.llm import order_minhash as O
    codes = np.frombuffer(text.encode("utf-32-le"), "<u4")
    if not len(codes):
        return ""
    hashes = O.kmer_hashes(codes, sketch.k).tolist()
    bits = max(20, len(hashes).bit_length())
    seen, items = {}, []
    for at, h in enumerate(hashes):
        h >>= bits
        n = seen[h] = seen.get(h, -1) + 1
        mixed = int(O._mix(np.array([(h * 0x9E3779B97F4A7C15 + n) % (1 << 64)], np.uint64))[0]) >> 32
        items.append((mixed, h, at))
    out = []
    for flip, scale in zip(sketch.flip.tolist(), sketch.scale.tolist()):
        low = sorted(items, key=lambda x: (((x[0] ^ flip) * scale) & 0xFFFFFFFF, x[1], x[2]))[:sketch.l]
        e = 0
        for _, h, _ in sorted(low, key=lambda x: x[2]):
            e = int(O._mix(np.array([(e * 0xD6E8FEB86659FD93 + h + 1) % (1 << 64)], np.uint64))[0])
        out.append(f"{e >> 48:04x}")
    return "".join(out)


def test_order_minhash_equals_brute_force_and_sees_order():
    from riskmart.llm.order_minhash import OrderMinHash
    s = OrderMinHash(k=4, l=2, m=16)
    for t in ("", "ab", "abcd", "aaaaaaaaaaaa", "the cat sat on the mat, the cat sat", "é中😀" * 9):
        assert s(t) == omh_brute(t, s)
    s = OrderMinHash()
    a, b = "".join(f"first block {i} " for i in range(60)), "".join(f"other part {i} " for i in range(60))
    moved, edited = s.likeness(s(a + b), s(b + a)), s.likeness(s(a + b), s(a + b[:-20]))
    assert s.likeness(s(a + b), s(a + b)) == 1.0 and edited > moved > s.likeness(s(a), s(b))


def test_fingerprints_follow_the_order_of_ids(spark):
    from riskmart.llm.order_minhash import OrderMinHash, fingerprints
    rng = random.Random(3)
    rows = [(i * 7, "".join(rng.choice("ab cdé😀") for _ in range(rng.randint(0, 80)))) for i in range(60)]
    rows += [(None, "null id text"), (5, None), (9, ""), (14, "tie"), (14, "tie"), (1000, "z" * 50_000)]
    df = spark.createDataFrame([(t, i, "x") for i, t in rows], "text string, doc_id long, id string").repartition(5)
    want = sorted(((-(1 << 63) if i is None else i), t or "", i) for i, t in rows)
    s = OrderMinHash()
    expect = []
    for (_, t, i), (_, following, _) in zip(want, want[1:] + want[:1]):
        half = len(t) // 2
        new = t[:len(t) - half] + following[:half]
        expect.append((str(i), len(t), hashlib.sha256(new.encode()).hexdigest(), s(t), s(new), s.likeness(s(t), s(new)), s.likeness(s(t), s(following))))
    for ranges in (1, 4, 30):
        got = [(str(r.doc_id), *tuple(r)[1:]) for r in fingerprints(df, ranges=ranges).collect()]
        assert sorted(got) == sorted(expect)
    assert fingerprints(df.limit(0)).count() == 0
    one = fingerprints(spark.createDataFrame([(1, "abcd")], "doc_id long, text string")).first()
    assert one.edited_sha256 == hashlib.sha256(b"abab").hexdigest() and one.near_next == 1.0


def base_brute(t):
    out = []
    for m in re.finditer(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", t, re.I | re.A):
        if len(m[2]) >= 6:
            out.append((m.start(), 0, m.end()))
    out += [(m.start(), 1, m.end()) for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 20]
    out += [(m.start(), 2, m.end()) for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 24]
    return ",".join(f"{('assign', 'access', 'hex')[k]}:{a}:{b}" for a, k, b in sorted(out))


SECRETS = ["password=hunter22 and Token : 'abc.def-123' API_KEY==zz", "secret:token:abcdefg", "AKIA" + "A1" * 8 + " AKIASHORT", "é" * 5 + "0a" * 20,
           "key aB3dE5fG7hJ9kL1mN3pQ5rS7tU9v end", "123e4567-e89b-12d3-a456-426614174000", "plain-words-joined-by-dashes-only", "ſecret=abcdef1", "x" * 60_000 + "passwd: longenough"]


def test_secrets_equal_brute_force(spark, odd):
    from riskmart.llm.secrets_scan import scan_secrets
    rows = odd + [(1000 + i, t, "s", 0) for i, t in enumerate(SECRETS)]
    texts = {}
    for d, t, *_ in rows:
        texts.setdefault(d, []).append(t or "")
    got = scan_secrets(frame(spark, rows, "doc_id long, text string, spans string, n_chars long"))
    assert got.columns == ["doc_id", "n_chars", "n_assign", "n_access", "n_hex", "n_entropy", "base_sha256", "spans"]
    for r in got.collect():
        options = {hashlib.sha256(base_brute(t).encode()).hexdigest(): t for t in texts[r.doc_id]}
        t = options[r.base_sha256]
        base = base_brute(t)
        kept = [s for s in r.spans.split(",") if s and not s.startswith("entropy")]
        assert ",".join(kept) == base
        assert (r.n_assign, r.n_access, r.n_hex) == tuple(base.count(k) for k in ("assign", "access", "hex"))
    by = {r.doc_id: r for r in got.collect()}
    assert by[1004].n_entropy == 1 and by[1005].n_entropy == by[1006].n_entropy == 0 and by[1007].n_assign == 0
    masked = {r.doc_id: r.text for r in scan_secrets(frame(spark, rows), mask="[S]").collect()}
    assert masked[1002].startswith("[S] AKIASHORT") and masked[0] is None and masked[5] == "a"
    assert scan_secrets(frame(spark, [])).count() == 0


def test_incremental_entropy_equals_brute_force():
    from riskmart.llm.secrets_scan import high_entropy_windows
    rng = random.Random(7)
    for _ in range(60):
        run = "".join(rng.choice("aab01Z9xyq/") for _ in range(rng.randint(0, 70)))
        width, threshold = 12, rng.choice([2.0, 2.5, 2.9])
        hit = set()
        for i in range(len(run) - width + 1):
            w = run[i:i + width]
            e = -sum(w.count(c) / width * math.log2(w.count(c) / width) for c in set(w))
            if e >= threshold - 1e-9 and sum(c.isdigit() for c in w) >= 2 and sum(c.isalpha() for c in w) >= 2:
                hit |= set(range(i, i + width))
        assert hit == {i for a, b in high_entropy_windows(run, width, threshold) for i in range(a, b)}


@pytest.mark.parametrize("kind", ["string", "binary", "date", "timestamp", "double", "decimal(30,2)", "boolean"])
def test_fingerprints_of_ids_of_any_type(spark, kind):
    import datetime
    from decimal import Decimal

    from riskmart.llm.order_minhash import fingerprints
    rng = random.Random(6)
    day = datetime.date(2025, 1, 1)
    ids = {"string": [f"doc-{i:05d}" for i in range(60)] + ["doc-é", ""], "binary": [bytes([7, i % 7, i]) for i in range(60)],
           "date": [day + datetime.timedelta(i) for i in range(60)], "timestamp": [datetime.datetime(2025, 1, 1, i % 24, i) for i in range(60)],
           "double": [i / 7 - 3 for i in range(60)] + [float("inf"), float("-inf")], "decimal(30,2)": [(Decimal(i) * 10 ** 20 + Decimal(i) / 4).quantize(Decimal("0.01")) for i in range(60)],
           "boolean": [True, False]}[kind]
    rows = [(i, f"text {rng.random()} of some length") for i in [*ids, None, ids[0], ids[1]]]
    df = spark.createDataFrame(rows, f"doc_id {kind}, text string").repartition(5)
    key = lambda r: (r[0] is not None, (r[0].encode() if kind == "string" else r[0]) if r[0] is not None else 0, r[1])
    order = sorted(((bytes(i) if kind == "binary" and i is not None else i, t) for i, t in rows), key=key)
    want = []
    for n, (i, text) in enumerate(order):
        following = order[(n + 1) % len(order)][1]
        half = len(text) // 2
        want.append((str(i), hashlib.sha256((text[:len(text) - half] + following[:half]).encode()).hexdigest()))
    for ranges in (None, 1, 13):
        got = [(str(bytes(r.doc_id) if kind == "binary" and r.doc_id is not None else r.doc_id), r.edited_sha256) for r in fingerprints(df, ranges=ranges).collect()]
        assert sorted(got) == sorted(want)
