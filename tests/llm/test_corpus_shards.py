"""Hash tree, conversation trie and resampling by brute force and on odd rows."""

import collections
import hashlib
import math
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from docfacts.llm import copies, hash_tree, prefix_trie, resampling
from docfacts.session import scratch_dir
from tests.llm.cases import frame, rows


def rank_key(value):
    return (value is None, value or 0)


# --- hash tree ---------------------------------------------------------------------


def descend(key, shards):
    """The shard of a key, by walking the tree with hashlib."""
    left = list(shards)
    path = ""
    for level in ("region", "rack", "number"):
        names = {}
        for s in left:
            name = f"shard{s.number}" if level == "number" else getattr(s, level)
            names.setdefault(name, []).append(s)

        def score(name):
            digits = hashlib.md5(f"{hash_tree.SEED}:{path}/{name}:{key}".encode()).hexdigest()[: hash_tree.DIGITS]
            return -math.log((int(digits, 16) + 0.5) / 16.0**hash_tree.DIGITS) / sum(s.weight for s in names[name])

        best = min(names, key=score)
        left, path = names[best], f"{path}/{best}"
    return left[0].number


def test_layout_by_brute_force(spark):
    found = hash_tree.layout(frame(spark)).collect()
    now = hash_tree.topology(8)
    want = []
    for doc_id, text, *_ in rows():
        data = (text or "").encode()
        key = "" if doc_id is None else str(doc_id)
        want.append((doc_id, len(data) + 1, zlib.crc32(data), "key", descend(key, now), descend(key, hash_tree.extended(now))))
    place = lambda r: (hashlib.md5(f"{'' if r[0] is None else r[0]}:{r[1]}:{r[2]}".encode()).hexdigest()[:3], rank_key(r[0]), r[1], r[2])
    full = []
    for shard in range(8):
        mine = sorted((r for r in want if r[4] == shard), key=place)
        full += [(*r[:5], slot, r[5]) for slot, r in enumerate(mine)]
    assert sorted(map(repr, found)) == sorted(
        f"Row(doc_id={r[0]}, size={r[1]}, text_crc32={r[2]}, law='key', shard={r[4]}, slot={r[5]}, grown_shard={r[6]})" for r in full
    )
    assert hash_tree.layout(frame(spark, [])).count() == 0


def shards_of(spark, shards, n=20_000):
    df = hash_tree.assign(spark.range(n).withColumnRenamed("id", "doc_id"), shards)
    return dict(map(tuple, df.select("doc_id", "shard").collect()))


def test_rows_move_only_where_weights_change(spark):
    base = hash_tree.topology(8)
    before = shards_of(spark, base)
    grown = shards_of(spark, hash_tree.extended(base))
    moved = [grown[k] for k in before if grown[k] != before[k]]
    assert set(moved) == {8} and abs(len(moved) / 20_000 - 1 / 9) < 0.01
    assert hash_tree.extended(base) == hash_tree.topology(9) and hash_tree.extended(hash_tree.topology(9)) == hash_tree.topology(10)
    heavier = [hash_tree.Shard(s.number, s.region, s.rack, 3.0 if s.number == 5 else 1.0) for s in base]
    after = shards_of(spark, heavier)
    region = {s.number: s.region for s in base}
    for k in before:
        if after[k] != before[k]:
            assert region[after[k]] == "region1", "rows move into the subtree that became heavier"
            if region[before[k]] == "region1":
                assert after[k] in (4, 5), "and inside it towards the heavier rack"
    counts = collections.Counter(after.values())
    assert all(abs(counts[s.number] / 20_000 - s.weight / 10) < 0.015 for s in heavier)
    with pytest.raises(ValueError, match="positive"):
        hash_tree.tree([hash_tree.Shard(0, "a", "b", 0.0)])


def test_slots_are_gapless_with_hot_ids_and_repeated_rows(spark):
    df = spark.range(4000).selectExpr(
        "IF(id % 3 = 0, 7L, IF(id % 3 = 1, NULL, id)) AS doc_id", "IF(id % 2 = 0, 'same', concat('t', id)) AS text", "id AS shard",
        "'x' AS slot",
    )
    found = hash_tree.layout(df).collect()
    for shard, slots in collections.Counter((r.shard) for r in found).items():
        assert sorted(r.slot for r in found if r.shard == shard) == list(range(slots))
    assert collections.Counter((r.doc_id, r.text_crc32) for r in found) == collections.Counter(
        (r.doc_id, zlib.crc32(r.text.encode())) for r in df.collect()
    )


def test_shard_folders(spark):
    path = scratch_dir(spark, "test-shards")
    hash_tree.write(frame(spark).drop("rank"), hash_tree.topology(8), path)
    read = spark.read.parquet(path)
    assert read.count() == len(rows()) and read.filter("shard <> 0").count() < len(rows())
    assert {(r.doc_id, r.shard) for r in read.collect()} == {
        (r[0], descend("" if r[0] is None else str(r[0]), hash_tree.topology(8))) for r in rows()
    }


def test_large_groups_are_expanded_in_pieces(spark):
    groups = spark.createDataFrame([("a", 25, 0), ("b", 3, 25), ("c", 1, 28), ("d", 10, 29)], "k string, n long, first long")
    found = copies.expanded(groups, "n", "first", "at", piece=10).collect()
    assert sorted((r["at"], r.k) for r in found) == list(enumerate("a" * 25 + "bbb" + "c" + "d" * 10))


# --- conversation trie -------------------------------------------------------------


def brute_trie(turns):
    own = collections.defaultdict(list)
    for conv, turn, role, text in turns:
        if conv is not None:
            size = str(len((role or "").encode()))
            sha = hashlib.sha256(f"{size}:{role or ''}{text or ''}".encode()).hexdigest()[:30]
            own[conv].append(((turn is not None, turn or 0, role or "", sha), (role or "", text or "")))
    own = {c: [t for _, t in sorted(found)] for c, found in own.items()}
    rebuilt = {}
    for c in own:
        h = zlib.crc32(str(c).encode()) % 6
        base = c - int(math.fmod(c, 100))
        rebuilt[c] = tuple(own.get(base, [])[:h] + own[c][h:])
    nodes = collections.defaultdict(list)
    for c, seq in rebuilt.items():
        for d in range(len(seq) + 1):
            nodes[seq[:d]].append(c)
    result = set()
    for seq, convs in nodes.items():
        below = [s for s in nodes if s[: len(seq)] == seq]
        kids = [s for s in below if len(s) == len(seq) + 1]
        inner = {s[:-1] for s in nodes if s}
        ends = ",".join(str(c) for c in sorted(convs) if len(rebuilt[c]) == len(seq))
        result.add((
            min(convs), len(seq), min(nodes[seq[:-1]]) if seq else None, len(convs), len(kids),
            sum(s not in inner for s in below), sum((len(nodes[s]) - 1) * (len(s[-1][1]) if s else 0) for s in below),
            hashlib.sha256(ends.encode()).hexdigest(),
        ))
    return result


def conversations(seed=1, n=260):
    """Few different turns, so that prefixes are shared; odd ids, nulls, repeated and equal turns, absent bases."""
    rng = random.Random(seed)
    found = []
    for c in rng.sample(range(-150, 450), n):
        for turn in range(rng.randrange(1, 9)):
            number = None if rng.random() < 0.1 else turn
            found.append((c, number, rng.choice(["user", "assistant", None, ""]), rng.choice(["a", "bé😀", "", None, "x" * 30])))
    found += [r for r in found if r[0] == found[0][0]]
    common = [("user", "hello"), ("assistant", "hi"), ("user", "bye")]
    found += [(c, t, *common[t]) for c in range(1000, 1090) for t in range(3)]
    found += [(5000, t, "user", f"turn {t % 3}") for t in range(400)] + [(5001, t, "user", f"turn {t % 3}") for t in range(300)]
    found += [(None, 0, "user", "a"), (None, None, None, None)]
    rng.shuffle(found)
    return found


CONVERSATIONS = "conv_id long, turn long, role string, text string"


def tuples(df):
    names = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")
    return {tuple(r[n] for n in names) for r in df.collect()}


def test_trie_by_brute_force(spark):
    turns = conversations()
    df = spark.createDataFrame(turns, CONVERSATIONS).selectExpr("*", "1 AS depth", "'x' AS f1", "turn AS place", "'y' AS size", "0 AS h")
    found = prefix_trie.trie(df)
    wanted = brute_trie(turns)
    assert tuples(found) == wanted and found.count() == len(wanted)
    assert prefix_trie.trie(spark.createDataFrame([], CONVERSATIONS)).count() == 0
    turnless = [(c, 0, "user", "a") for c in (7, 9, 250)]
    assert tuples(prefix_trie.trie(spark.createDataFrame(turnless, CONVERSATIONS))) == brute_trie(turnless)


def test_colliding_fingerprints_are_found(spark):
    """With tiny primes different prefixes meet; the references tell, and the next base is tried."""
    turns = [t for t in conversations(3, 14) if t[0] is not None and t[0] < 1000]
    df = spark.createDataFrame(turns, CONVERSATIONS)
    _, nodes = prefix_trie.verified(df, scratch_dir(spark, "test-trie"), 0, (5, 5, 5, 5))
    assert "nodes-0/" not in nodes.inputFiles()[0]
    assert nodes.count() == len(brute_trie(turns))


def test_members_refer_to_stored_turns(spark):
    turns = [(c, t, "user", f"{c}:{t}") for c in (100, 101, 103, 117) for t in range(8)]
    for r in prefix_trie.members(spark.createDataFrame(turns, CONVERSATIONS)).filter("depth > 0").collect():
        h = zlib.crc32(str(r.conv_id).encode()) % 6
        assert (r.ref_conv, r.ref_place) == (100 if r.depth <= h else r.conv_id, r.depth)


# --- resampling --------------------------------------------------------------------

WORDS = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def brute_resample(docs, target, order, buckets=10_000, least=20, percent=10, seed=2024):
    def found(text):
        w = WORDS.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
        runs = [" ".join(w[i : i + n]) for n in range(1, order + 1) for i in range(len(w) - n + 1)]
        return len(w), [zlib.crc32(r.encode()) % buckets for r in runs]

    given = [(doc_id, *found(text)) for doc_id, text in docs]
    s = collections.Counter(b for _, _, bs in given for b in bs)
    t = collections.Counter(b for text in target for b in found(text)[1])
    all_s, all_t = sum(s.values()), sum(t.values())
    gain = lambda b: math.floor(1000 * math.log((t[b] + 1) * (all_s + buckets) / ((s[b] + 1) * (all_t + buckets))))
    scored = []
    for doc_id, n_words, bs in given:
        weight = sum(map(gain, bs)) // len(bs) if bs else 0
        h = int(hashlib.sha256(f"{seed}:{'' if doc_id is None else doc_id}".encode()).hexdigest()[:8], 16)
        scored.append([doc_id, n_words, len(bs), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), None])
    long_enough = sorted((r for r in scored if r[1] >= least), key=lambda r: (-r[4], rank_key(r[0]), r[2], r[3]))
    for place, r in enumerate(long_enough[: percent * len(long_enough) // 100]):
        r[5] = place + 1
    return sorted(map(repr, map(tuple, scored)))


@pytest.mark.parametrize("order, head, percent", [(1, 8, 30), (2, 8, 50), (3, 50, 100)])
def test_resampling_by_brute_force(spark, monkeypatch, order, head, percent):
    monkeypatch.setattr(resampling, "BLOCK_WORDS", 50)
    target = [rows()[3][1][:200], "ÉCOLE été <b>W1X</b> a_b", None, ""]
    some = [*rows(), *[(20 + i, f"{rows()[3][1]} extra{i}", "en", "a", 1, "m", 1, "c") for i in range(15)], *[rows()[3]] * 9]
    df = frame(spark, some).withColumnsRenamed({"rank": "n", "mark": "score"}).withColumn("rank", F.lit("x"))
    wanted = spark.createDataFrame([(t,) for t in target], "text string")
    found = resampling.resample(df, wanted, order, head=head, percent=percent)
    plain = [(r[0], r[1]) for r in some]
    assert sorted(repr(tuple(r)) for r in found.collect()) == brute_resample(plain, target, order, percent=percent)


def test_resampling_of_nothing(spark):
    nothing = spark.createDataFrame([], "text string")
    assert resampling.resample(frame(spark, []), nothing).count() == 0
    plain = [(r[0], r[1]) for r in rows()]
    found = resampling.resample(frame(spark), nothing)
    assert sorted(repr(tuple(r)) for r in found.collect()) == brute_resample(plain, [], 1)
