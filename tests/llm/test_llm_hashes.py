"""Fingerprints, near-duplicates and shards against brute force."""

import hashlib
import random
import re
import zlib

import pytest
import xxhash
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lotlens.llm import fingerprint, near_dedup, sharding, simhash
from lotlens.llm.common import ascii_lower, numbered, split_words
from lotlens.llm.components import components
from lotlens.llm.queries import op1_fingerprints, op4_near_dedup, op7_sharding

DOC = "doc_id long, text string"
SF = "/root/testdata/sf0.001"


def plain_fingerprint(text, size=3):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    terms = [" ".join(words[i : i + size]) for i in range(max(1, len(words) - size + 1))]
    hashes = [xxhash.xxh64(t.encode(), seed=42).intdigest() for t in terms]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def plain_components(prints, radius):
    """Smallest id reachable for a list of (id, fingerprint)."""
    root = {i: i for i in range(len(prints))}

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(prints)):
        for j in range(i):
            if (prints[i][1] ^ prints[j][1]).bit_count() <= radius:
                a, b = find(i), find(j)
                root[max(a, b)] = min(a, b)
    least = {}
    for i, (key, _) in enumerate(prints):
        r = find(i)
        least[r] = min([k for k in (least.get(r), key) if k is not None], default=None)
    return [(key, f, least[find(i)]) for i, (key, f) in enumerate(prints)]


TEXTS = [
    "The quick brown fox jumps over the lazy dog " * 30,
    "The quick brown fox jumps over the lazy dog " * 29 + "The quick brown fox jumps over the lazy cat",
    "THE QUICK brown fox jumps over the lazy dog " * 30,
    "",
    None,
    " \t\n",
    "one",
    "one two",
    "one two three",
    "Éa éA ß ÉA",
    "x" * 50_000,
    "a b " * 20_000,
]


def test_near_duplicates_against_brute_force(spark):
    rows = [(i * 3 + 5, t) for i, t in enumerate(TEXTS)] + [(5, TEXTS[0]), (None, TEXTS[6]), (None, "no other text")]
    df = spark.createDataFrame([(*r, "z", "y") for r in rows], DOC + ", fingerprint string, _row string")
    got = [tuple(r) for r in near_dedup.near_duplicates(df, "doc_id", "text").collect()]
    prints = [(k, plain_fingerprint(t)) for k, t in rows]
    wanted = [(k, f"{f:016x}", c) for k, f, c in plain_components(prints, 2)]
    order = lambda r: tuple(map(str, r))
    assert sorted(got, key=order) == sorted(wanted, key=order)


def test_op4_on_whole_table(spark):
    rows = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    wanted = plain_components([(k, plain_fingerprint(t)) for k, t in rows], 2)
    got = [tuple(r) for r in op4_near_dedup(spark, SF).collect()]
    assert sorted(got) == sorted((k, f"{f:016x}", c) for k, f, c in wanted)


@pytest.mark.parametrize("radius,segments", [(1, 16), (2, 16), (2, 8), (2, 32)])
def test_links_connect_what_is_near(spark, radius, segments):
    rng = random.Random(radius * segments)
    base = [rng.getrandbits(64) for _ in range(15)]
    prints = set(base)
    for b in base:  # chains and bushes of neighbours
        at = b
        for _ in range(12):
            for _ in range(rng.randint(1, 3)):
                at ^= 1 << rng.randrange(64)
            prints.add(at)
            prints.add(b ^ (1 << rng.randrange(64)))
    prints |= {0, (1 << 64) - 1, 1 << 63, 3}
    prints = sorted(prints)
    signed = [(p - (1 << 64) if p >> 63 else p,) for p in prints]
    df = spark.createDataFrame(signed, "fingerprint long")
    edges = near_dedup.links(df, radius, segments)
    found = {r[0]: r[1] for r in components(edges, "a", "b").collect()}
    mine = {p: found.get(p, p) for (p,) in signed}
    brute = plain_components(list(zip(range(len(prints)), prints)), radius)
    groups = lambda pairs: sorted(sorted(g) for g in _grouped(pairs))
    assert groups([(i, mine[s]) for i, (s,) in enumerate(signed)]) == groups([(i, c) for i, _, c in brute])


def _grouped(pairs):
    out = {}
    for i, g in pairs:
        out.setdefault(g, []).append(i)
    return out.values()


def test_links_make_no_pairs_within_a_group(spark):
    """All values within one bit of each other's centre: 65 nodes give 64 links a centre, not 2,080."""
    values = [(0,)] + [(simhash._signed(1 << i),) for i in range(64)]
    df = spark.createDataFrame(values, "fingerprint long")
    assert near_dedup.links(df).count() <= 65 * 64


def test_components_on_paths_stars_and_loops(spark):
    rng = random.Random(3)
    edges = [(i, i + 1) for i in range(0, 60)] + [(100, i) for i in range(101, 140)] + [(7, 7), (200, 201), (201, 200)]
    rng.shuffle(edges)
    got = {r[0]: r[1] for r in components(spark.createDataFrame(edges, "a long, b long"), "a", "b").collect()}
    assert got == {**{i: 0 for i in range(1, 61)}, **{i: 100 for i in range(101, 140)}, 201: 200}
    assert components(spark.createDataFrame([], "a long, b long"), "a", "b").count() == 0


def test_keep_one(spark):
    rows = [(3, "a b c d"), (1, "a b c d"), (1, "a b c d"), (2, "quite another text here"), (None, "a b c d"), (None, "only without id x"), (None, "only without id x")]
    df = spark.createDataFrame([(*r, 1) for r in rows], DOC + ", component_id int")
    kept = near_dedup.keep_one(df, "doc_id", "text")
    assert kept.columns == df.columns
    assert sorted((str(r[0]), r[1]) for r in kept.collect()) == [("1", "a b c d"), ("2", "quite another text here"), ("None", "only without id x")]


def test_votes_over_many_blocks(spark):
    """A text of several blocks whose weights would overflow one lane."""
    text = " ".join(f"w{i % 977}" for i in range(simhash.BLOCK * 3 + 17))
    df = spark.createDataFrame([(1, text)], DOC)
    got = near_dedup.fingerprints(df, "doc_id", "text").first()["fingerprint"]
    assert got % (1 << 64) == plain_fingerprint(text)


def plain_op1(text):
    words = (text or "").lower().split()
    if not words:
        return [0, 0]
    terms = [" ".join(words[i : i + 2]) for i in range(max(1, len(words) - 1))]
    out = []
    for seed in (None, 1):
        total, votes = 0, [0] * 64
        for t in terms:
            # xxhash64 of several columns hashes each with the hash before as its seed
            start = 42 if seed is None else xxhash.xxh64(int(seed).to_bytes(4, "little"), seed=42).intdigest()
            h, w = xxhash.xxh64(t.encode(), seed=start).intdigest(), min(len(t), 15)
            total += w
            for b in range(64):
                votes[b] += w * (h >> b & 1)
        out.append(sum(1 << b for b in range(64) if 2 * votes[b] > total))
    return out


def check_op1(docs, got):
    order = sorted(docs, key=lambda r: (-r[0], r[1] or ""))
    like = lambda a, b: 1 - sum((x ^ y).bit_count() for x, y in zip(a, b)) / 128
    wanted = []
    for i, (key, text) in enumerate(order):
        text, after = text or "", order[(i + 1) % len(order)][1] or ""
        half = len(text) // 2
        edit = text[: len(text) - half] + after[:half]
        f, e, n = plain_op1(text), plain_op1(edit), plain_op1(after)
        hexed = lambda p: f"{p[0]:016x}{p[1]:016x}"
        wanted.append((key, len(text), hashlib.sha256(edit.encode()).hexdigest(), hexed(f), hexed(e), like(f, e), like(f, n)))
    assert sorted(got) == sorted(wanted)


def test_fingerprints_against_brute_force(spark):
    docs = [(i * 7 - 20, t) for i, t in enumerate(TEXTS)] + [(-20, "repeated id"), (-20, "repeated id")]
    df = spark.createDataFrame([(*d, 1) for d in docs], DOC + ", n_chars int")
    got = fingerprint.compare_with_edits(df, "doc_id", "text").drop("_f0", "_f1")
    check_op1(docs, [tuple(r) for r in got.collect()])
    one = fingerprint.compare_with_edits(df.filter("doc_id = 1"), "doc_id", "text").first()
    assert one["near_next"] == 1.0
    assert fingerprint.compare_with_edits(df.filter("doc_id = -999"), "doc_id", "text").count() == 0
    nulls = spark.createDataFrame([(None, "a b"), (4, "c d"), (None, None)], DOC)
    assert fingerprint.compare_with_edits(nulls, "doc_id", "text").count() == 3


def test_op1_on_whole_table(spark):
    docs = [tuple(r) for r in spark.read.parquet(f"{SF}/documents.parquet").select("doc_id", "text").collect()]
    got = op1_fingerprints(spark, SF)
    rows = got.collect()
    check_op1(docs, [tuple(r)[:-1] for r in got.select("doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next", "n_near").collect()])
    prints = {r["doc_id"]: int(r["fingerprint"], 16) for r in rows}
    for r in rows:
        if r["doc_id"] % 100 == 0:
            near = sum((prints[r["doc_id"]] ^ p).bit_count() <= fingerprint.RADIUS for k, p in prints.items() if k != r["doc_id"])
            assert r["n_near"] == near
        else:
            assert r["n_near"] is None


@pytest.mark.parametrize("radius,blocks", [(0, 2), (2, 4), (3, 4), (3, 8), (4, 3), (6, 5), (17, 4), (17, 18), (5, None)])
def test_block_tables_find_all_within_radius(spark, radius, blocks):
    rng = random.Random(9)
    base = [rng.getrandbits(128) for _ in range(20)]
    prints = set(base)
    for b in base:
        for _ in range(8):
            for _ in range(rng.randint(1, 5)):
                b ^= 1 << rng.randrange(128)
            prints.add(b)
    split = lambda p: (simhash._signed(p >> 64), simhash._signed(p & (1 << 64) - 1))
    df = spark.createDataFrame([split(p) for p in prints], "_f0 long, _f1 long")
    queries = spark.createDataFrame([split(p) for p in base], "_f0 long, _f1 long")
    got = sorted(tuple(r) for r in fingerprint.within_radius(queries, df, radius, blocks).collect())
    assert got == sorted((*split(q), *split(p)) for q in base for p in prints if (q ^ p).bit_count() <= radius)


def test_number_of_blocks_follows_the_size():
    for radius in (0, 1, 5, 17, 40):
        chosen = [fingerprint.choose_blocks(n // 100, n, radius) for n in (10**3, 10**5, 10**7, 10**9, 10**11)]
        assert chosen == sorted(chosen, reverse=True), chosen  # fewer and wider as the table grows
    million = fingerprint.choose_blocks(10**4, 10**6)
    assert all(
        fingerprint.search_rows(10**4, 10**6, fingerprint.RADIUS, million)
        <= fingerprint.search_rows(10**4, 10**6, fingerprint.RADIUS, b)
        for b in range(4, 19)
    )
    cuts = [b for n in range(2, 20) for b in fingerprint._cuts(n)]
    assert all(high - low <= 64 for low, high in cuts)


def test_counts_of_repeated_prints(spark):
    near = 0b111
    rows = [(0, 0, 0), (1, 0, 0), (2, 0, near), (3, near, 0), (None, 0, 0), (5, -1, -1), (6, -1, -1)]
    df = spark.createDataFrame(rows, "doc_id long, _f0 long, _f1 long")
    got = fingerprint.count_near(df, F.col("doc_id") % 2 == 0, 3).collect()
    # the row without an id is found, but does not ask
    assert {r["doc_id"]: r["n_near"] for r in got} == {0: 4, 1: None, 2: 3, 3: None, None: None, 5: None, 6: 1}
    assert fingerprint.count_near(df.limit(0), F.col("doc_id") % 2 == 0, 3).count() == 0


def test_search_finds_near_copies(spark):
    rng = random.Random(4)
    vocabulary = ["".join(rng.choices("abcdefghijklmnop", k=rng.randint(2, 9))) for _ in range(2000)]
    runs = lambda words: {tuple(words[i : i + 5]) for i in range(len(words) - 4)}
    docs = []
    for i in range(60):
        words = rng.choices(vocabulary, k=rng.randint(150, 400))
        copy = list(words)
        for at in rng.sample(range(len(copy)), len(copy) // 60):
            copy[at] = rng.choice(vocabulary)
        a, b = runs(words), runs(copy)
        assert 0.8 <= len(a & b) / len(a | b) < 1
        docs += [(2 * i, " ".join(words)), (2 * i + 1, " ".join(copy))]
    df = spark.createDataFrame(docs, DOC)
    prints = fingerprint.fingerprints(df, ["doc_id"], "text")
    got = {r["doc_id"]: r["n_near"] for r in fingerprint.count_near(prints, F.col("doc_id") % 2 == 0).collect()}
    found = [got[2 * i] for i in range(60)]
    assert set(found) <= {0, 1} and sum(found) >= 57


@pytest.mark.parametrize("radius,blocks", [(5, 4), (17, 6)])
def test_search_is_whole_beyond_one_bit_a_block(spark, radius, blocks):
    rng = random.Random(3)
    base = [rng.getrandbits(128) for _ in range(6)]
    prints = [b ^ sum(1 << x for x in rng.sample(range(128), n)) for b in base for n in range(radius - 2, radius + 3) for _ in range(20)]
    split = lambda p: (simhash._signed(p >> 64), simhash._signed(p & (1 << 64) - 1))
    df = spark.createDataFrame([split(p) for p in set(prints)], "_f0 long, _f1 long")
    queries = spark.createDataFrame([split(p) for p in base], "_f0 long, _f1 long")
    got = sorted(tuple(r) for r in fingerprint.within_radius(queries, df, radius, blocks).collect())
    assert got == sorted((*split(q), *split(p)) for q in base for p in set(prints) if (q ^ p).bit_count() <= radius)


def test_range_numbers_agree_with_counting(spark):
    cuts = [1, 4, 9, 10, 30, 31, 32, 80]
    keys = [None, -5, 0, 1, 2, 4, 9, 10, 29, 30, 31, 33, 80, 99]
    df = spark.createDataFrame([(k,) for k in keys], "k long")
    got = {r[0]: r[1] for r in df.select("k", fingerprint._range_number(F.col("k"), cuts)).collect()}
    assert got == {k: -1 if k is None else sum(c <= k for c in cuts) for k in keys}


def test_ascii_lower_and_words(spark):
    text = "ÀB Cd\tE\x0bf\xa0G  ß"
    df = spark.createDataFrame([(text,), (None,), ("",)], "t string")
    assert df.select(ascii_lower(F.col("t"))).first()[0] == "Àb cd\te\x0bf\xa0g  ß"
    got = [r[0] for r in df.select(split_words(F.col("t"), r"\x20\x09-\x0D")).collect()]
    assert got == [["ÀB", "Cd", "E", "f\xa0G", "ß"], [], []]


def test_numbers_are_gapless(spark):
    df = spark.range(1000).select((F.col("id") % 3).alias("g"), (F.col("id") % 400).alias("v"))
    for g, rows in _by(numbered(df, ["g"], ["v"], "n").collect()).items():
        assert sorted(r["n"] for r in rows) == list(range(len(rows))), g


def _by(rows, name="g"):
    out = {}
    for r in rows:
        out.setdefault(r[name], []).append(r)
    return out


def plain_best_fit(sizes, capacity):
    rooms = []
    for s in sorted(sizes, reverse=True):
        fits = [i for i, r in enumerate(rooms) if r >= s]
        if fits:
            at = min(fits, key=lambda i: (rooms[i], i))
            rooms[at] -= s
        else:
            rooms.append(capacity - s)
    return rooms


def test_best_fit_matches_one_item_at_a_time():
    rng = random.Random(1)
    for _ in range(40):
        sizes = [rng.randint(1, 60) for _ in range(rng.randint(1, 80))]
        histogram = [(s, sizes.count(s)) for s in set(sizes)]
        plan = sharding.best_fit_decreasing(histogram, 100)
        used = {}
        for size, a, b, shard in plan:
            used[shard] = used.get(shard, 0) + size * (b - a)
        assert sorted(100 - u for u in used.values()) == sorted(plain_best_fit(sizes, 100))
    with pytest.raises(ValueError):
        sharding.best_fit_decreasing([(101, 1)], 100)


def test_rooms_keep_order():
    rng = random.Random(2)
    rooms, mirror = sharding.Rooms(), []
    for i in range(500):
        if rng.random() < 0.6:
            room = rng.randint(0, 50)
            rooms.add(room, i)
            mirror.append((room, i))
        else:
            size = rng.randint(0, 60)
            fits = sorted(m for m in mirror if m[0] >= size)
            assert rooms.take_tightest(size) == (fits[0] if fits else None)
            if fits:
                mirror.remove(fits[0])


def test_hot_group_gets_a_shard_and_the_rest_is_even(spark):
    rows = [("hot", 4000)] * 100 + [(f"g{i}", 10 + i % 17) for i in range(3000)] + [(None, 5), (None, 6), ("null size", None)]
    df = spark.createDataFrame(rows, "g string, s int").withColumn("shard_", F.lit(1)).withColumnRenamed("shard_", "_size")
    out = sharding.shard_groups(df, "g", "s", shards=4)
    assert out.count() == len(rows)
    assert all(len({r["shard"] for r in rs}) == 1 for rs in _by(out.collect()).values())
    sums = {r[0]: r[1] for r in out.groupBy("shard").agg(F.sum("s")).collect()}
    assert len(sums) == 4
    rest = sorted(sums.values())[:3]
    assert rest[-1] - rest[0] <= 0.01 * rest[-1]


def test_fixed_capacity_opens_few_shards(spark):
    df = spark.createDataFrame([(str(i), 30 + i % 5) for i in range(200)], "g string, s int")
    out = sharding.shard_groups(df, "g", "s", capacity=320)
    sums = [r[0] for r in out.groupBy("shard").agg(F.sum("s")).select("sum(s)").collect()]
    assert max(sums) <= 320
    assert len(sums) <= 23
    assert sharding.shard_groups(df.limit(0), "g", "s", shards=8).count() == 0


def test_shards_of_clashing_columns(spark):
    rows = [("a", 3, 9, "x", 1), ("a", 3, 9, "x", 1), ("b", 5, 9, "y", 2), (None, 2, 9, None, 3)]
    df = spark.createDataFrame(rows, "g string, s int, shard int, _group string, _class int")
    for how in ({"shards": 2}, {"capacity": 8}):
        out = sharding.shard_groups(df, "g", "s", **how)
        assert out.columns == ["g", "s", "_group", "_class", "shard"]
        kept = sorted(map(str, ((*r[:2], *r[3:]) for r in rows)))
        assert sorted(str(tuple(r)[:4]) for r in out.collect()) == kept
        assert {r["shard"] for r in out.collect()} == {0, 1}


def test_op7_null_empty_and_long_texts(spark, tmp_path):
    rows = [(1, None), (2, ""), (3, "é" * 300_000), (3, "é" * 300_000), (4, "b"), (None, "b")]
    df = spark.createDataFrame([(*r, 7) for r in rows], DOC + ", shard int")
    df.write.parquet(str(tmp_path / "documents.parquet"))
    got = sorted(((r["doc_id"], r["size"], r["shard"]) for r in op7_sharding(spark, str(tmp_path)).collect()), key=str)
    assert [r[:2] for r in got] == [(1, 1), (2, 1), (3, 600_001), (3, 600_001), (4, 2), (None, 2)]
    shards = [r[2] for r in got]
    assert shards[0] == shards[1] and shards[2] == shards[3] and shards[4] == shards[5]


def test_op7(spark):
    rows = op7_sharding(spark, SF).collect()
    docs = {r["doc_id"]: r["text"] for r in spark.read.parquet(f"{SF}/documents.parquet").collect()}
    assert sorted(r["doc_id"] for r in rows) == sorted(docs)
    where = {}
    for r in rows:
        raw = (docs[r["doc_id"]] or "").encode()
        assert (r["size"], r["text_crc32"], r["law"], r["grown_shard"]) == (len(raw) + 1, zlib.crc32(raw), "bytes", None)
        assert where.setdefault(raw, r["shard"]) == r["shard"]
    by = _by(rows, "shard")
    assert sorted(by) == list(range(8))
    sums = [sum(r["size"] for r in rs) for rs in by.values()]
    assert max(sums) - min(sums) <= 0.02 * max(sums)
    for rs in by.values():
        assert sorted(r["slot"] for r in rs) == list(range(len(rs)))


def test_schemas(spark):
    assert op7_sharding(spark, SF).schema["grown_shard"].dataType == T.IntegerType()
    assert op4_near_dedup(spark, SF).columns == ["doc_id", "fingerprint", "component_id"]
