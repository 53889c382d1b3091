"""Deduplicating operators against brute force."""

import hashlib
import random

import numpy as np
import pytest
import xxhash

from tests.llm.support import awkward_texts, by_id, documents, empty
from tripstream.llm import exact_dedup, line_dedup, simhash, suffix_array
from tripstream.llm.components import components
from tripstream.llm.exact_dedup import exact_duplicates


def lowered(text):
    return "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")


def sha(data):
    return hashlib.sha256(data if isinstance(data, bytes) else data.encode()).hexdigest()


@pytest.mark.parametrize("copies", [0, 300])
def test_exact_duplicates(spark, copies):
    texts = [*awkward_texts(), *["A frequent TEXT"] * copies]
    found = exact_duplicates(documents(spark, texts))
    groups = {}
    for i, t in enumerate(texts):
        groups.setdefault(lowered(t), []).append(i)
    wanted = {i: (max(g), len(g), i == max(g), sha(t)) for t, g in groups.items() for i in g}
    assert by_id(found, "keep_id", "group_size", "kept", "text_sha256") == wanted
    assert exact_duplicates(empty(spark)).count() == 0


def test_exact_duplicates_of_repeated_and_null_ids(spark):
    rows = [(None, "a"), (None, "A"), (3, "b"), (3, "b"), (2, "B"), (None, None)]
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    kept = exact_dedup.drop_exact_duplicates(docs).collect()
    assert sorted((lowered(r["text"]), r["doc_id"] or 0) for r in kept) == [("", 0), ("a", 0), ("b", 3)]


@pytest.mark.parametrize("copies", [0, 200])
def test_frequent_lines(spark, copies):
    texts = [*awkward_texts(), *[f"own line {i % 150}\nShared" for i in range(copies)]]
    seen = {}
    strip = " \t\n\x0b\f\r"
    for t in texts:
        for k in {lowered(x.strip(strip)) for x in (t or "").split("\n")}:
            seen[k] = seen.get(k, 0) + 1
    wanted = {}
    for i, t in enumerate(texts):
        lines = (t or "").split("\n")
        stay = [x for x in lines if not (k := lowered(x.strip(strip))) or seen[k] < 10]
        wanted[i] = (len(lines), len(lines) - len(stay), "\n".join(stay))
    found = line_dedup.frequent_lines_dropped(documents(spark, texts))
    assert by_id(found, "n_lines", "n_dropped", "kept_text") == wanted
    assert line_dedup.frequent_lines_dropped(empty(spark)).count() == 0


def test_perfect_hash_has_no_gaps():
    keys = np.unique(np.random.default_rng(3).integers(0, 2**63, 20_000).astype(np.uint64))
    index = line_dedup.PerfectHash.of(keys)
    assert sorted(index.place(keys).tolist()) == list(range(len(keys)))
    assert sum(8 * len(w) for w in index.levels) * 8 < 5 * len(keys)
    assert line_dedup.PerfectHash.of(keys[:0]).place(keys[:3]).tolist() == [-1, -1, -1]


def brute_fingerprint(text):
    words = [w for w in __import__("re").split(r"[\x20\x09-\x0D]+", lowered(text)) if w]
    if not words:
        return 0
    shingles = [" ".join(words[i : i + 3]) for i in range(max(1, len(words) - 2))]
    hashes = [xxhash.xxh64_intdigest(s.encode(), 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def brute_components(prints, radius):
    root = list(range(len(prints)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i] ^ prints[j]).bit_count() <= radius:
                a, b = sorted((find(i), find(j)))
                root[b] = a
    return [find(i) for i in range(len(prints))]


def test_simhash(spark):
    texts = awkward_texts()
    prints = [brute_fingerprint(t) for t in texts]
    roots = brute_components(prints, 3)
    found = simhash.near_duplicates(documents(spark, texts))
    assert by_id(found, "fingerprint", "component_id") == {i: (f"{p:016x}", r) for i, (p, r) in enumerate(zip(prints, roots, strict=True))}
    kept = simhash.drop_near_duplicates(documents(spark, [*texts, *texts[:3]]))
    assert sorted(r["doc_id"] for r in kept.collect()) == sorted(set(roots))
    assert simhash.near_duplicates(empty(spark)).count() == 0


def test_simhash_drops_repeated_rows_and_bears_null_ids(spark):
    rows = [(1, "one two three four"), (1, "one two three four"), (None, "five six seven eight"), (None, "nine ten eleven twelve")]
    kept = simhash.drop_near_duplicates(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted(r["text"].split()[0] for r in kept.collect()) == ["five", "nine", "one"]


@pytest.mark.parametrize("radius", [0, 1, 2, 3, 4, 5, 6])
def test_close_pairs(radius):
    rng = np.random.default_rng(radius)
    left = rng.integers(0, 2**63, 200).astype(np.uint64)
    right = np.concatenate([left[:50] ^ (np.uint64(1) << rng.integers(0, 64, 50).astype(np.uint64)), left[20:60] ^ np.uint64(0b10110010), rng.integers(0, 2**63, 90).astype(np.uint64)])
    a, b = simhash.close_pairs(left, right, radius)
    x, y = np.nonzero(np.bitwise_count(left[:, None] ^ right[None, :]) <= radius)
    assert sorted(zip(a.tolist(), b.tolist(), strict=True)) == sorted(zip(x.tolist(), y.tolist(), strict=True))


def test_links_of_tiled_and_split_buckets(spark, monkeypatch):
    rng = random.Random(5)
    prints = {rng.getrandbits(64) for _ in range(150)}
    for p in list(prints)[:60]:
        prints |= {p ^ (1 << rng.randrange(64)) ^ (1 << rng.randrange(64)) for _ in range(3)}
    prints = sorted(p - 2**63 for p in prints)
    monkeypatch.setattr(simhash, "BUCKET", 16)
    monkeypatch.setattr(simhash, "TILE", 8)
    frame = spark.createDataFrame([(p,) for p in prints], "print long")
    found = {r["node"]: r["root"] for r in components(simhash.links(frame, 3), "a", "b").collect()}
    roots = brute_components([p & (2**64 - 1) for p in prints], 3)
    assert [found.get(p, p) for p in prints] == [prints[r] for r in roots]


def test_components_of_a_long_chain_and_a_star(spark):
    links = [(i, i + 1) for i in range(60)] + [(100, i) for i in range(101, 160)] + [(7, 7)]
    random.Random(2).shuffle(links)
    found = {r["node"]: r["root"] for r in components(spark.createDataFrame(links, "a long, b long"), "a", "b").collect()}
    assert found == {i: 0 for i in range(61)} | {i: 100 for i in range(100, 160)}


def brute_passages(rows, span):
    low = {}
    for i, text in rows:
        for a in range(len(text) - span + 1):
            s = text[a : a + span]
            low[s] = min(low.get(s, i), i)
    out = []
    for i, text in rows:
        gone = bytearray(len(text))
        for a in range(len(text) - span + 1):
            if low[text[a : a + span]] < i:
                gone[a : a + span] = b"\1" * span
        runs = sum(1 for k in range(len(gone)) if gone[k] and not (k and gone[k - 1]))
        out.append((i, len(text), sum(gone), runs, bytes(b for b, g in zip(text, gone, strict=True) if not g)))
    return out


@pytest.mark.parametrize(("span", "block", "bucket"), [(50, 2_000_000, 1 << 20), (50, 3000, 256), (20, 700, 64), (33, 900, 100)])
def test_repeated_passages(spark, monkeypatch, span, block, bucket):
    monkeypatch.setattr(suffix_array, "BLOCK_BYTES", block)
    monkeypatch.setattr(suffix_array, "BUCKET", bucket)
    texts = awkward_texts(7)
    wanted = {i: rest for i, *rest in brute_passages([(i, (t or "").encode()) for i, t in enumerate(texts)], span)}
    found = suffix_array.repeated_passages_removed(documents(spark, texts), span=span)
    assert {i: list(r) for i, r in by_id(found, "n_bytes", "n_removed", "n_spans", "kept_bytes").items()} == wanted


def test_repeated_passages_bear_null_and_repeated_ids(spark):
    text = "abcdefghij" * 6
    rows = [(None, text), (None, text), (5, text), (5, text), (4, "z" * 70)]
    found = suffix_array.repeated_passages_removed(spark.createDataFrame(rows, "doc_id long, text string"))
    assert sorted((r["doc_id"] or 0, r["n_removed"]) for r in found.collect()) == [(0, 0), (0, 0), (4, 0), (5, 60), (5, 60)]
    assert suffix_array.repeated_passages_removed(empty(spark)).count() == 0
    cut = suffix_array.drop_repeated_passages(documents(spark, [text, text, "é" * 30 + text]), length_column="n_chars")
    assert by_id(cut, "text", "n_chars") == {0: (text, 60), 1: ("", 0), 2: ("é" * 30, 30)}


def brute_lines(texts, least=10):
    keys = [[lowered(line.strip(" \t\n\v\f\r")) for line in (t or "").split("\n")] for t in texts]
    often = {k for k in {k for ks in keys for k in ks} if k and sum(k in set(ks) for ks in keys) >= least}
    return {i: (len(ks), sum(k in often for k in ks), "\n".join(line for line, k in zip((t or "").split("\n"), ks, strict=True) if k not in often))
            for i, (t, ks) in enumerate(zip(texts, keys, strict=True))}


def test_lines_whose_hashes_are_equal_are_all_found(spark, monkeypatch):
    own = line_dedup.hashed
    monkeypatch.setattr(line_dedup, "hashed", lambda key: line_dedup.F.struct((own(key)["h"] % 4).alias("h"), own(key)["c"].alias("c")))
    rng = random.Random(6)
    texts = ["\n".join(rng.sample([f"line {n}" for n in range(16)], 5)) for _ in range(40)] + [f"only {n}" for n in range(20)]
    found = line_dedup.frequent_lines_dropped(documents(spark, texts))
    assert by_id(found, "n_lines", "n_dropped", "kept_text") == brute_lines(texts)


CLASHES = ["id", "ID_", "gone", "stay", "h", "c", "n", "shard", "print", "root", "__print", "__root", "component", "low", "node", "rows", "block", "text2"]


def clashing(spark, texts, *more):
    names = [*CLASHES, *more]
    return spark.createDataFrame([(i, t, *(f"{n} {i}" for n in names)) for i, t in enumerate(texts)], f"doc_id long, text string, {', '.join(f'`{n}` string' for n in names)}")


@pytest.mark.parametrize(("operator", "more", "added"), [
    (line_dedup.frequent_lines_dropped, ["N_Lines"], 3), (simhash.near_duplicates, ["FINGERPRINT"], 2),
    (simhash.drop_near_duplicates, ["FINGERPRINT"], 0), (suffix_array.repeated_passages_removed, ["N_BYTES"], 4),
    (suffix_array.drop_repeated_passages, ["N_BYTES"], 0)])
def test_every_other_column_goes_through_under_its_name(spark, operator, more, added):
    texts = [t for t in awkward_texts(4) if t and len(t) < 2000]
    found = operator(clashing(spark, texts, *more))
    assert found.columns[: 2 + len(CLASHES)] == ["doc_id", "text", *CLASHES] and len(found.columns) == 2 + len(CLASHES) + added
    rows = found.collect()
    assert rows and all(r[n] == f"{n} {r['doc_id']}" for r in rows for n in CLASHES)
