import hashlib
import random
import re

import numpy as np
import pytest
from pyspark.sql import functions as F

from bramble.llm import exact_dedup, line_dedup, simhash, substring_dedup
from bramble.llm.components import connected_components
from bramble.llm.textbytes import Words
from conftest import SF_MID, SF_SMALL
from helpers import components, documents, fingerprint, odd_rows, without_repeats
from oracle_harness import duck


def load(sf):
    return duck(sf).execute("select doc_id, text from documents order by doc_id").fetchall()


# ---- components

def test_components_of_long_chain_star_and_cycle(spark):
    edges = [(i, i + 1) for i in range(60)] + [(100, 200 + i) for i in range(40)] + [(300, 301), (301, 302), (302, 300), (7, 7)]
    got = {r.node: r.component for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = {**{i: 0 for i in range(61)}, 100: 100, **{200 + i: 100 for i in range(40)}, 300: 300, 301: 300, 302: 300}
    assert got == want


def test_components_empty(spark):
    assert connected_components(spark.createDataFrame([], "a long, b long")).count() == 0


# ---- SimHash

def test_triples_cover_every_spread_of_four_bits():
    import itertools
    for spread in itertools.product(range(5), repeat=len(simhash.BLOCKS)):
        if sum(spread) <= simhash.MAX_BITS:
            assert any(sum(spread[b] for b in t) <= 1 for t in simhash.TRIPLES)


def test_every_pair_within_four_bits_meets():
    rng = random.Random(3)
    for _ in range(400):
        x = rng.getrandbits(64)
        y = x
        for b in rng.sample(range(64), rng.randint(0, 4)):
            y ^= 1 << b
        home, _ = simhash.anchors(np.array([x], np.uint64), False)
        visits, _ = simhash.anchors(np.array([y], np.uint64), True)
        assert set(home.tolist()) & set(visits.tolist())


def test_anchors_are_code_words_within_two_bits():
    fp = np.array([0, 1, 2 ** 64 - 1, 0x123456789ABCDEF0], np.uint64)
    keys, rows = simhash.anchors(fp, True)
    for t, (word, width) in enumerate(simhash.triple_words(fp)):
        pick = (keys.view(np.uint64) >> np.uint64(40)) == t
        anchor = keys.view(np.uint64)[pick] & np.uint64((1 << 40) - 1)
        assert not simhash.syndrome(anchor).any()
        assert (np.bitwise_count(anchor ^ word[rows[pick]]) <= 2).all()


def test_links_equal_brute_force_in_dense_cluster(spark):
    rng = random.Random(5)
    fps = {0, -1}
    for _ in range(12):
        centre = rng.getrandbits(64)
        for _ in range(25):
            x = centre
            for b in rng.sample(range(64), rng.randint(0, 4)):
                x ^= 1 << b
            fps.add(x - (1 << 64) if x >> 63 else x)
    fps = sorted(fps)
    got = {(r.a, r.b) for r in simhash.links(spark.createDataFrame([(f,) for f in fps], "fp long")).collect()}
    want = {(a, b) for i, a in enumerate(fps) for b in fps[i + 1:] if bin((a ^ b) & (2 ** 64 - 1)).count("1") <= 4}
    assert got == want
    with pytest.raises(ValueError):
        simhash.links(spark.createDataFrame([(1,)], "fp long"), max_bits=5)


def test_homes_and_visitors_are_not_broadcast(spark):
    """They have 6 and 100 rows or so for each fingerprint; the planner counts one."""
    found = simhash.links(spark.range(1000).select(F.xxhash64("id").alias("fp")))
    plan = lambda: found._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan() and "Broadcast" not in plan()
    found.collect()
    assert "SortMergeJoin" in plan() and "Broadcast" not in plan()


@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_simhash_equals_brute_force(spark, sf):
    rows = load(sf)
    fps = {d: fingerprint(t) for d, t in rows}
    byfp = {}
    for d, f in fps.items():
        byfp.setdefault(f, []).append(d)
    comp = components(sorted(byfp), lambda a, b: (a ^ b).bit_count() <= 4)
    first = {}
    for f, ds in byfp.items():
        first[comp[f]] = min(first.get(comp[f], ds[0]), *ds)
    got = {r.doc_id: (r.fingerprint, r.component_id) for r in simhash.simhash_near_dedup(
        spark.read.parquet(f"{sf}/documents.parquet")).collect()}
    assert got == {d: (f"{f:016x}", first[comp[f]]) for d, f in fps.items()}


def test_simhash_odd_rows(spark):
    docs = documents(spark, odd_rows())
    got = simhash.simhash_near_dedup(docs).collect()
    assert len(got) == len(odd_rows())
    zero = [r for r in got if r.fingerprint == "0" * 16]
    assert {r.doc_id for r in zero} == {1, 2, 3, None} and {r.component_id for r in zero} == {1}
    base = {r.component_id for r in got if r.doc_id in (4, 5, 6, 13)}
    assert base == {4}
    kept = simhash.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    ids = [r.doc_id for r in kept.collect()]
    assert len(ids) == len(set(ids)) and 4 in ids and 5 not in ids and None not in ids
    assert simhash.simhash_near_dedup(docs.limit(0)).count() == 0
    assert simhash.drop_near_duplicates(docs.limit(0)).count() == 0


def test_near_duplicates_without_ids_keep_one_row(spark):
    docs = documents(spark, [(None, "same words here"), (None, "same words here"), (None, "same  words here")])
    assert simhash.drop_near_duplicates(docs).count() == 1


# ---- exact dedup

def brute_exact(rows):
    groups = {}
    for d, t in rows:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]", "", t or ""), []).append((-len(t or ""), d is None, d or 0, d))
    out, taken = [], set()
    for d, t in rows:
        norm = re.sub(r"[\x20\x09-\x0D]", "", t or "")
        best = min(groups[norm])
        kept = d == best[3] and -best[0] == len(t or "") and norm not in taken
        if kept:
            taken.add(norm)
        out.append((d, best[3], len(groups[norm]), kept, hashlib.sha256(norm.encode()).hexdigest()))
    return sorted(out, key=str)


@pytest.mark.parametrize("capacity", [1 << 20, 3])
def test_exact_dedup_odd_rows(spark, capacity):
    rows = odd_rows() + [(5, "twice"), (5, "twice"), (5, "twi ce"), (None, "no id"), (None, "no id")]
    docs = documents(spark, rows)
    got = exact_dedup.exact_dedup(docs, bucket_capacity=capacity).collect()
    assert sorted(map(tuple, got), key=str) == brute_exact(rows)
    assert exact_dedup.exact_dedup(docs.limit(0)).count() == 0


def test_exact_dedup_of_a_table_through_many_buckets(spark):
    docs = spark.read.parquet(f"{SF_MID}/documents.parquet").select("doc_id", "text")
    rows = [tuple(r) for r in docs.collect()]
    got = exact_dedup.exact_dedup(docs, bucket_capacity=16).collect()
    assert sorted(map(tuple, got), key=str) == brute_exact(rows)


def test_exact_dedup_walks_chains_of_one_key(spark):
    """Four keys only, so nearly every chain holds several texts."""
    rows = odd_rows() + [(100 + i, f"text {i % 40}") for i in range(200)]
    docs = documents(spark, rows)
    got = exact_dedup.exact_dedup(docs, bucket_capacity=2, hash_key=lambda c: F.crc32(F.encode(c, "UTF-8")) % 4).collect()
    assert sorted(map(tuple, got), key=str) == brute_exact(rows)


def test_exact_dedup_with_text_ids(spark):
    rows = [("b", "x y"), ("a", "xy "), ("c", "xy"), (None, "x y"), ("a", "xy "), (None, "z")]
    docs = spark.createDataFrame(rows, "doc_id string, text string")
    got = sorted((tuple(r)[:4] for r in exact_dedup.exact_dedup(docs).collect()), key=str)
    assert got == sorted([("b", "a", 5, False), ("a", "a", 5, True), ("c", "a", 5, False), (None, "a", 5, False), ("a", "a", 5, False),
                          (None, None, 1, True)], key=str)


def test_directory_splits_only_overfull_buckets(spark):
    # 40 keys under prefix 00..., 2 under 11...
    keys = spark.createDataFrame([(i << 55,) for i in range(40)] + [(-1,), (-2 << 40,)], "key long")
    slots, depth = exact_dedup.directory(keys, 8)
    held = keys.withColumn("slot", exact_dedup.slot(F.col("key"), depth)).join(slots, "slot")
    sizes = {r.bucket: (r["count"], r.local_depth) for r in held.groupBy("bucket", "local_depth").count().collect()}
    assert sum(n for n, _ in sizes.values()) == 42
    assert all(n <= 8 for n, _ in sizes.values())
    assert min(d for _, d in sizes.values()) == 1 < max(d for _, d in sizes.values())


# ---- substring dedup

@pytest.mark.parametrize("sf", [SF_SMALL, SF_MID])
def test_substring_dedup_equals_brute_force(spark, sf):
    docs = spark.read.parquet(f"{sf}/documents.parquet")
    want = without_repeats(dict(load(sf)), 50)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(docs).collect()}
    assert got == want


def test_substring_dedup_of_overlapping_shifts(spark):
    """Windows shared at many offsets, with several classes under one gram."""
    rng = random.Random(9)
    stream = [f"t{rng.randrange(50)}" for _ in range(600)]
    rows = [(d, " ".join(["x%d" % d, *stream[s:s + n], "y%d" % d])) for d, (s, n) in enumerate(
        (rng.randrange(400), rng.randrange(40, 180)) for _ in range(60))]
    docs = documents(spark, rows)
    want = without_repeats(dict(rows), 50)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(docs).collect()}
    assert got == want
    cut = {r.doc_id: r.text for r in substring_dedup.remove_repeats(docs).collect()}
    assert {d: hashlib.sha256(b" ".join(t.encode().split())).hexdigest() for d, t in cut.items()} == {d: w[2] for d, w in want.items()}


def test_words_built_to_collide_stay_apart(spark):
    """The Thue-Morse word of two letters and its complement agree under any polynomial modulo
    2^64; in two documents that differ in this word alone no window is shared."""
    a = "".join("ab"[bin(i).count("1") % 2] for i in range(1 << 11))
    words = [f"w{i}" for i in range(50)]
    docs = documents(spark, [(1, " ".join([*words[:25], a, *words[25:]])),
                             (2, " ".join([*words[:25], a.translate(str.maketrans("ab", "ba")), *words[25:]]))])
    got = {r.doc_id: r.n_removed for r in substring_dedup.substring_dedup(docs).collect()}
    assert got == {1: 0, 2: 0}


def test_words_of_one_batch_have_their_own_numbers():
    texts = ["a", "a\0", "\0a", "\0", "\0\0", "ä", "abcdefgh", "abcdefgh\0", "abcdefghi", "\0" * 9, "\0" * 8]
    docs, first, second, start = Words().read([t.encode() for t in texts])
    assert docs.tolist() == list(range(len(texts) + 1)) and len(set(first.tolist())) == len(set(second.tolist())) == len(texts)
    _, again, _, _ = Words().read([" ".join(reversed(texts)).encode()])
    assert again.tolist() == first.tolist()[::-1]


def test_saturated_sketch_loses_nothing(spark):
    rows = load(SF_SMALL)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    want = without_repeats(dict(rows), 50)
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring_dedup.substring_dedup(docs, max_log_width=6).collect()}
    assert got == want


@pytest.mark.parametrize("log_width, max_log_width", [(6, 30), (6, 5), (12, 11), (20, 19)])
def test_sketch_of_any_width_loses_nothing(spark, log_width, max_log_width):
    """Broadcast or met in blocks, saturated or wide."""
    rows = load(SF_SMALL)
    docs = documents(spark, rows)
    want = without_repeats(dict(rows), 50)
    got = substring_dedup.substring_dedup(docs, max_log_width=max_log_width, log_width=log_width).collect()
    assert {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in got} == want


@pytest.mark.parametrize("log_width, share", [(20, 0.001), (6, 1.0)])
def test_blocks_of_the_sketch_pass_repeated_grams_and_few_others(spark, log_width, share):
    rows = load(SF_MID)
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(7)
    counts = {}
    words = Words()
    for _, t in rows:
        for k in substring_dedup.Occurrences(words, [(t or "").encode()]).key.view(np.int64).tolist():
            counts[k] = counts.get(k, 0) + 1
    got = [r.key for r in substring_dedup.repeated_keys(docs, log_width, 50, 25).collect()]
    repeated = {k for k, n in counts.items() if n > 1}
    assert len(got) == len(set(got)) and repeated <= set(got) <= set(counts)
    assert len(set(got) - repeated) <= share * (len(counts) - len(repeated))


def test_substring_dedup_odd_rows(spark):
    docs = documents(spark, odd_rows())
    got = substring_dedup.substring_dedup(docs).collect()
    assert len(got) == len(odd_rows())
    by_id = {}
    for r in got:
        by_id.setdefault(r.doc_id, []).append((r.n_words, r.n_removed))
    assert by_id[4] == [(80, 0)] and by_id[5] == [(80, 80)] * 2 and by_id[6] == [(81, 80)]
    assert sorted(by_id[None]) == [(0, 0), (80, 80)] and by_id[7] == [(30000, 0)] and by_id[8] == [(30001, 30000)]
    assert by_id[1] == by_id[2] == by_id[3] == [(0, 0)]
    kept = substring_dedup.remove_repeats(docs)
    assert kept.columns == docs.columns and kept.count() == len(odd_rows())
    rows = {r.doc_id: r for r in kept.collect()}
    assert rows[6].text == "tail" and rows[6].n_chars == 4 and rows[9].text == odd_rows()[10][1]
    assert substring_dedup.substring_dedup(docs.limit(0)).count() == 0


def test_sliding_min():
    x = np.array([5, 3, 8, 1, 9, 2, 7], np.uint64)
    for width in range(1, 8):
        assert substring_dedup.sliding_min(x, width).tolist() == [min(x[i:i + width]) for i in range(len(x) - width + 1)]


# ---- line dedup

def test_patience_alignment():
    # crossing lines: the longest sequence in order stays
    assert line_dedup.align([(0, 2, True), (1, 0, True), (2, 1, True)]) == [(1, 0), (2, 1)]
    # a repeated line between anchors is aligned in its gap
    assert line_dedup.align([(0, 0, True), (1, 1, False), (2, 2, True)]) == [(0, 0), (1, 1), (2, 2)]
    assert line_dedup.align([(0, 0, True), (1, 9, False), (2, 2, True)]) == [(0, 0), (2, 2)]
    assert line_dedup.align([]) == []


def test_longest_increasing_equals_brute_force():
    import itertools
    rng = random.Random(1)
    for _ in range(50):
        v = [rng.randrange(9) for _ in range(8)]
        got = line_dedup.longest_increasing(v)
        assert all(v[a] < v[b] for a, b in zip(got, got[1:]))
        best = max(n for n in range(9) for c in itertools.combinations(v, n) if all(a < b for a, b in zip(c, c[1:])))
        assert len(got) == best


def test_line_dedup_blocks(spark):
    a, b, c = "first line of the five words", "second line with its own words", "short one"
    rows = [(1, f"{a}\n{b}\n{c}"), (2, f"new text that is only here\n\n{a}\n{b}\n{c}"), (3, f"{c}\nquite another text of its own"),
            (4, f"{b}\n{a}"), (5, None), (6, "")]
    docs = documents(spark, rows)
    out = {r.doc_id: r for r in line_dedup.keep_new_lines(docs).collect()}
    assert out[1].text == rows[0][1]
    assert out[2].text == "new text that is only here\n" and out[2].n_chars == len(out[2].text)
    assert out[3].text == rows[2][1]  # a coincidence under five words stays
    assert out[4].text in (a, b)      # crossing lines: one of them is aligned with document 1
    assert out[5].text is None and out[6].text == ""
    digest = {r.doc_id: (r.n_lines, r.n_removed) for r in line_dedup.line_dedup(docs).collect()}
    assert digest[2] == (4, 3) and digest[5] == (0, 0)


def test_line_dedup_frequent_and_rare_lines_lose_no_pair(spark):
    common = "a very common line in all the texts"
    rows = [(d, f"{common}\nown text number {d} with enough words\nshared by two or three texts {d % 30} again") for d in range(90)]
    out = {r.doc_id: r.text.split("\n") for r in line_dedup.keep_new_lines(documents(spark, rows)).collect()}
    for d in range(90):
        want = ([common] if d == 0 else []) + [rows[d][1].split("\n")[1]] + ([rows[d][1].split("\n")[2]] if d < 30 else [])
        assert out[d] == want


def test_line_dedup_odd_rows(spark):
    docs = documents(spark, odd_rows())
    out = line_dedup.keep_new_lines(docs)
    assert out.columns == docs.columns and out.count() == len(odd_rows())
    rows = {}
    for r in out.collect():
        rows.setdefault(r.doc_id, []).append(r.text)
    assert rows[4] == [odd_rows()[3][1]] and rows[5] == ["", ""] and rows[12] == ["a\n\na\na"]
    assert line_dedup.line_dedup(docs.limit(0)).count() == 0
