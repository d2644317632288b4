"""The operators on rows that are null, empty, blank, long, repeated or tied, against brute force."""

import hashlib
import os
import random
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
import pytest
import sentencepiece
import tiktoken
import xxhash
from pyspark.sql import functions as F

from verdance.llm import archive, bytebpe, decontaminate, exactcopies, graph, language, nearcopies, pagetext, quality, sharding, tokencount

LONG = " ".join(f"w{i * 7919 % 5003}" for i in range(30_000))
SCHEMA = "doc_id long, text string, lang string, source string, n_chars long, rid long, _text string, key string, comp long"


def documents(spark, rows=None):
    """Rows with every odd case; further columns have names that the operators use themselves."""
    rnd = random.Random(5)
    vocabulary = [a + b for a in ("ka", "lo", "mi", "un", "pre", "sta") for b in ("r", "na", "tion", "ss", "", "ö")]
    texts = [" ".join(rnd.choices(vocabulary, k=rnd.randint(1, 60))) for _ in range(40)]
    texts += [t.replace(" ", "\n", 1) for t in texts[:5]] + [t + " extra" for t in texts[5:12]] + texts[:3]
    texts += [None, "", " \t\n", "one", "One", "a b", "12 34 --", "日本 語", "x  y   z ", " lead", "🙂🙂 ok", "é é", LONG, LONG + " tail", "a▁b ▁", "don't they'll"]
    own = [(i, t) for i, t in enumerate(texts)] + [(None, "nobody's text"), (None, None), (3, texts[3]), (3, "other text, same id")]
    rows = own if rows is None else rows
    return spark.createDataFrame([(i, t, "en", "s", len(t or ""), 1, "x", "k", 2) for i, t in rows], SCHEMA)


@pytest.fixture(scope="module")
def docs(spark):
    return documents(spark)


def empty(docs):
    return docs.where("false")


def listed(df, *columns):
    return sorted(((*(r[c] for c in columns),) for r in df.collect()), key=repr)


def test_token_counts(docs):
    sp = sentencepiece.SentencePieceProcessor(model_file=public_tokenizers.path(tokencount.MODEL))
    for salted in (tokencount.SALTED, 1):  # with and without salting of common pre-tokens
        got = listed(tokencount.count_tokens(docs, salted=salted), "doc_id", "n_bytes", "n_tokens", "over_limit")
        want = []
        for r in docs.collect():
            n = len(sp.encode(r["text"] or ""))
            want.append((r["doc_id"], len((r["text"] or "").encode()), n, n > 4096))
        assert got == sorted(want, key=repr)
    assert tokencount.count_tokens(empty(docs)).collect() == []


def test_byte_bpe_round_trip(docs):
    tokens = bytebpe.read_ranks(public_tokenizers.path(bytebpe.RANKS))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    coded = bytebpe.encode(docs)
    want = []
    for r in docs.collect():
        ids = plain.encode_ordinary(r["text"] or "")
        packed = np.array(ids, "<u4").tobytes()
        want.append((r["doc_id"], len(ids), hashlib.sha256(packed).hexdigest(), hashlib.sha256((r["text"] or "").encode()).hexdigest(), ids))
    assert listed(coded, "doc_id", "n_tokens", "ids_sha256", "decoded_sha256", "ids") == sorted(want, key=repr)
    back = listed(bytebpe.decode(coded), "doc_id", "text")
    assert back == sorted(((r["doc_id"], r["text"] or "") for r in docs.collect()), key=repr)
    assert bytebpe.encode(empty(docs)).collect() == []


def test_byte_bpe_blanks_and_memory():
    tokens, table = bytebpe.vocabulary(public_tokenizers.path(bytebpe.RANKS))
    assert [table.find(t) for t in tokens[::97]] == list(range(0, len(tokens), 97))
    plain = tiktoken.Encoding("own", pat_str=public_tokenizers.PATTERN, mergeable_ranks={t: i for i, t in enumerate(tokens)}, special_tokens={})
    encode = bytebpe.Encoder(tokens, table, public_tokenizers.PATTERN)
    rnd = random.Random(1)
    signs = "ab A1,.'s \n\t\x1c\x85\xa0　²日é🙂"
    for _ in range(3000):
        text = "".join(rnd.choices(signs, k=rnd.randint(0, 25)))
        assert np.frombuffer(encode(text), "<u4").tolist() == plain.encode_ordinary(text), repr(text)
    word = ("ab" * 20_000 + "c").encode()
    assert encode.merged(word) == plain.encode_ordinary(word.decode())


def test_sharding_laws(docs):
    rows = sharding.shard(docs).collect()
    assert len(rows) == docs.count()
    places = defaultdict(list)
    for r in rows:
        places[r["shard"]].append(r["slot"])
        assert 0 <= r["shard"] < 24 and r["law"] == "key"
        assert r["grown_shard"] in (r["shard"], 24)
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    want = Counter((r["doc_id"], len((r["text"] or "").encode()) + 8, zlib.crc32((r["text"] or "").encode())) for r in docs.collect())
    assert Counter((r["doc_id"], r["size"], r["text_crc32"]) for r in rows) == want
    # the id and the number of shards decide, whatever else is in the table
    alone = {r["doc_id"]: r["shard"] for r in sharding.shard(docs.where("doc_id < 9")).collect()}
    assert alone == {r["doc_id"]: r["shard"] for r in rows if r["doc_id"] in alone}
    assert sharding.shard(empty(docs)).collect() == []


def test_sharding_numbers_a_hot_id_in_pieces(spark):
    table = documents(spark, [(None if i % 2 else 7, f"text {i}") for i in range(600)])
    sharded = sharding.shard(table)
    assert any("slot-map" in f for f in sharded.inputFiles())
    places = defaultdict(list)
    for r in sharded.collect():
        places[r["shard"]].append(r["slot"])
    assert sum(map(len, places.values())) == 600
    assert all(sorted(p) == list(range(len(p))) for p in places.values())
    plan = sharded._jdf.queryExecution().optimizedPlan().toString()
    numbered = next(line for line in plan.splitlines() if "row_number" in line and "Window" in line)
    assert re.search(r"\[vslot#\d+, sub#\d+\], \[_key", numbered)


def test_sharding_maps():
    now = sharding.slot_map(24)
    counts = Counter(now)
    assert max(counts.values()) - min(counts.values()) <= 24 and set(counts) == set(range(24))
    more = sharding.grown(now, 24)
    assert all(b in (a, 24) for a, b in zip(now, more, strict=True)) and Counter(more)[24] == sharding.SLOTS // 25
    rnd = random.Random(2)
    sizes = [rnd.randint(0, 1000) for _ in now]
    moved = sharding.rebalance(now, sizes, 24)
    load = lambda m: [sum(s for s, x in zip(sizes, m, strict=True) if x == k) for k in range(24)]
    assert max(load(moved)) - min(load(moved)) < 1000 <= max(load(now)) - min(load(now))
    assert sum(load(moved)) == sum(sizes)


def test_sharding_map_holds_and_evens_out_bytes(docs):
    slots = {(r["doc_id"], r["size"]): r["vslot"] for r in sharding.shard(docs, 5, 64).collect()}
    records, size = Counter(), Counter()
    for r in docs.collect():
        n = len((r["text"] or "").encode()) + 8
        slot = slots[r["doc_id"], n]
        records[slot] += 1
        size[slot] += n
    rows = sharding.rebalanced(docs, 5, 64).collect()
    now, more = ({r["vslot"]: r for r in rows if r["map_version"] == v} for v in (0, 1))
    for version in (now, more):
        assert len(version) == 64 and all((r["records"], r["bytes"]) == (records[s], size[s]) for s, r in version.items())
    assert [now[s]["shard"] for s in range(64)] == sharding.slot_map(5, 64)
    assert [more[s]["shard"] for s in range(64)] == sharding.rebalance(sharding.slot_map(5, 64), [size[s] for s in range(64)], 5)
    none = sharding.rebalanced(empty(docs), 5, 64).collect()
    assert len(none) == 128 and not any(r["records"] or r["bytes"] for r in none)


@pytest.mark.parametrize("parts", [1, 7])
def test_block_names_are_ranks(spark, docs, parts):
    held = {k: spark.conf.get(k) for k in ("spark.sql.shuffle.partitions", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.shuffle.partitions", parts)
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        got = {(r["text_sha256"], r["n_blocks"], r["name"]) for r in exactcopies.identities(docs.repartition(parts), block=50).collect()}
    finally:
        for k, v in held.items():
            spark.conf.set(k, v)
    norms = {re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in docs.collect()}
    left = {n: [n[i : i + 50] for i in range(0, len(n), 50)] for n in norms}
    counts, want = {n: len(b) for n, b in left.items()}, set()

    def order(x):
        """Blocks are ordered by their two hashes, as signed numbers, pairs by their names."""
        if not isinstance(x, str):
            return x
        seed = xxhash.xxh64_intdigest((1).to_bytes(4, "little"), 42)
        return [(xxhash.xxh64_intdigest(x.encode(), s) + 2**63) % 2**64 for s in (42, seed)]

    while left:
        place = {x: i for i, x in enumerate(sorted({x for b in left.values() for x in b}, key=order))}
        for n, b in list(left.items()):
            named = [place[x] for x in b]
            if len(named) <= 1:
                want.add((hashlib.sha256(n.encode()).hexdigest(), counts[n], named[0] if named else -1))
                del left[n]
            else:
                left[n] = [(named[i], named[i + 1] if i + 1 < len(named) else -1) for i in range(0, len(named), 2)]
    assert got == want


@pytest.mark.parametrize("block", [3, 16, 4096])
def test_exact_duplicates(docs, block):
    groups, every = defaultdict(list), docs.collect()
    for r in every:
        groups[re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")].append(r["doc_id"])
    if block == 3:
        docs = docs.where("text is null or length(text) < 5000")
        every = docs.collect()
        groups = {k: v for k, v in groups.items() if len(k) < 5000}
    got = listed(exactcopies.exact_duplicates(docs, block), "doc_id", "keep_id", "group_size", "text_sha256")
    want = []
    for r in every:
        norm = re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "")
        ids = groups[norm]
        keep = min((i for i in ids if i is not None), default=None)
        want.append((r["doc_id"], keep, len(ids), hashlib.sha256(norm.encode()).hexdigest()))
    assert got == sorted(want, key=repr)
    assert exactcopies.exact_duplicates(docs, block).where("kept").count() == len(groups)


def test_exact_stage_keeps_columns(docs):
    kept = exactcopies.drop_exact_duplicates(docs)
    assert kept.columns == docs.columns
    norms = [re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in kept.collect()]
    assert len(norms) == len(set(norms)) == len({re.sub(r"[\x20\x09-\x0D]+", " ", r["text"] or "") for r in docs.collect()})
    assert exactcopies.drop_exact_duplicates(empty(docs)).collect() == []


def shingles(text, size):
    words = (text or "").encode().lower().split()
    k = min(size, len(words))
    return frozenset(tuple(words[i : i + k]) for i in range(len(words) - k + 1)) if words else frozenset()


def linked(sets, threshold=80):
    """Components by comparing all."""
    root = list(range(len(sets)))

    def find(i):
        while root[i] != i:
            i = root[i]
        return i

    for i in range(len(sets)):
        for j in range(i):
            if sets[i] and sets[j]:
                both = len(sets[i] & sets[j])
                if 100 * both >= threshold * (len(sets[i]) + len(sets[j]) - both):
                    a, b = sorted((find(i), find(j)))
                    root[b] = a
    return [find(i) for i in range(len(sets))]


def near_rows():
    """Chains of near-copies, a crowd that shares a passage, and odd rows."""
    rnd = random.Random(11)
    words = [f"v{i}" for i in range(400)]
    texts = []
    for _ in range(4):  # each differs a little from the one before, ends differ much
        base = rnd.choices(words, k=80)
        for _ in range(9):
            texts.append(" ".join(base))
            base = list(base)
            base[rnd.randrange(80)] = rnd.choice(words)
    passage = rnd.choices(words, k=60)
    texts += [" ".join(passage + rnd.choices(words, k=25)) for _ in range(40)]
    return [(i, t) for i, t in enumerate(texts)]


@pytest.mark.parametrize("most, block", [(nearcopies.PICKED_MOST, nearcopies.BLOCK), (0, 4)])
def test_near_duplicates(spark, docs, monkeypatch, most, block):
    monkeypatch.setattr(nearcopies, "PICKED_MOST", most)
    monkeypatch.setattr(nearcopies, "BLOCK", block)
    table = docs.unionByName(documents(spark, [(1000 + i, t) for i, t in near_rows()]))
    every = table.collect()
    comps = linked([shingles(r["text"], 2) for r in every])
    low = defaultdict(list)
    for r, c in zip(every, comps, strict=True):
        low[c].append(r["doc_id"])
    want = []
    for r, c in zip(every, comps, strict=True):
        keep = min((i for i in low[c] if i is not None), default=None)
        want.append((r["doc_id"], len(shingles(r["text"], 2)), keep, r["doc_id"] == keep))
    got = listed(nearcopies.near_duplicates(table), "doc_id", "n_shingles", "component_id", "kept")
    assert got == sorted(want, key=repr)


def test_near_groups_tied_by_one_pair(spark):
    """Two dense groups have a single link, between members that are nobody's center."""
    one, texts = [f"w6x{i}" for i in range(240)], []
    places = [3 + 4 * i for i in range(15)]
    two = [f"q6x{i}" if i in places else w for i, w in enumerate(one)]
    for side, base, other in (("a", one, two), ("b", two, one)):
        members = [list(base) for _ in range(100)]
        for i in range(1, 99):
            members[i][64 + i] = f"{side}6x{i}"
        place = places[side == "b"]
        members[99][place] = other[place]
        texts += [" ".join(m) for m in members]
    sets = [shingles(t, 2) for t in texts]
    met = [(i, j) for i in range(100) for j in range(100, 200) if 100 * len(sets[i] & sets[j]) >= 80 * len(sets[i] | sets[j])]
    assert met == [(99, 199)]
    got = nearcopies.near_duplicates(documents(spark, list(enumerate(texts))))
    assert {r["component_id"] for r in got.collect()} == {0}


def test_near_stage_keeps_one_of_each(docs):
    kept = nearcopies.drop_near_duplicates(docs)
    assert kept.columns == docs.columns
    every = docs.collect()
    comps = linked([shingles(r["text"], 5) for r in every])
    assert kept.count() == len(set(comps))
    assert nearcopies.drop_near_duplicates(empty(docs)).collect() == []
    assert nearcopies.near_duplicates(empty(docs)).collect() == []


def test_hyperminhash_estimates():
    rnd = np.random.default_rng(3)
    for shared in (0, 300, 800, 1000):
        common = rnd.integers(0, 1 << 63, shared, np.uint64)
        a, b = (np.concatenate([common, rnd.integers(0, 1 << 63, 1000 - shared, np.uint64)]) for _ in range(2))
        a, b = a << np.uint64(1), b << np.uint64(1)
        s = [nearcopies.registers(x)[None] for x in (a, b)]
        j = nearcopies.estimate(*s, np.array([1000]), np.array([1000]))[0]
        assert abs(j - shared / (2000 - shared)) < 0.13


def test_components_of_a_path_and_a_star(spark):
    path = [(i, i + 1) for i in range(100, 140)]
    star = [(500, i) for i in range(501, 530)] + [(530, 500)]
    odd = [(7, 7), (3, 1), (1, 3), (3, 1)]
    got = {r["node"]: r["comp"] for r in graph.components(spark.createDataFrame(path + star + odd, "a long, b long")).collect()}
    want = {i: 100 for i in range(100, 141)} | {i: 500 for i in range(500, 531)} | {7: 7, 1: 1, 3: 1}
    assert got == want


def benchmark(spark, rows):
    return spark.createDataFrame(rows, "item_id long, text string")


def contained(docs, items):
    words = lambda t: [w for w in re.split(r"[^\w]|_", (t or "").lower()) if w]
    best = {}
    for item_id, text in items:
        w = words(text)
        k = min(5, len(w))
        own = {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if w else set()
        for r in docs:
            d = words(r["text"])
            n = len(own & {tuple(d[i : i + k]) for i in range(len(d) - k + 1)}) if own else 0
            if own and 100 * n >= 80 * len(own):
                key = (r["doc_id"], item_id)
                best[key] = max(best.get(key, (0, 0)), (len(own), n))
    return sorted(((*k, *v) for k, v in best.items()), key=repr)


@pytest.mark.parametrize("sketch_most", [200_000, 0])
def test_decontamination(spark, docs, sketch_most, monkeypatch):
    rnd = random.Random(4)
    words = [f"q{i}" for i in range(300)]
    items = [(i, " ".join(rnd.choices(words, k=n))) for i, n in enumerate([5, 6, 9, 14, 14, 30, 60, 120])]
    items += [(8, "one"), (9, "a b"), (10, None), (11, ""), (12, "--"), (None, " ".join(rnd.choices(words, k=20))), (13, items[4][1])]
    planted = []
    for i, (_, text) in enumerate(items):
        if text:
            planted.append((2000 + i, LONG[:3000] + " " + text.upper() + ". " + LONG[:500]))
            w = text.split()
            planted.append((3000 + i, "x " + " ".join(w[: int(len(w) * 0.9)]) + " y"))
            planted.append((4000 + i, "x " + " ".join(w[: int(len(w) * 0.7)]) + " y"))
    table = docs.unionByName(documents(spark, planted))
    found = decontaminate.leaks(table, benchmark(spark, items), sketch_most=sketch_most)
    want = contained(table.collect(), items)
    got = found.groupBy("doc_id", "item_id").agg(F.max("n").alias("n"), F.max("shared").alias("shared"))
    assert listed(got, "doc_id", "item_id", "n", "shared") == want
    if sketch_most:
        clean = decontaminate.drop_contaminated(table, benchmark(spark, items))
        bad = {(r["doc_id"], r["text_hash"]) for r in found.collect()}
        assert clean.columns == table.columns
        keys = table.select("doc_id", F.xxhash64("text").alias("h")).collect()
        assert clean.count() == sum((r["doc_id"], r["h"]) not in bad for r in keys)
        assert decontaminate.contaminated(empty(docs), benchmark(spark, items)).collect() == []
        assert decontaminate.contaminated(docs, benchmark(spark, [(1, ""), (2, None)])).collect() == []
        assert decontaminate.drop_contaminated(docs, benchmark(spark, [])).count() == docs.count()


@pytest.mark.parametrize("length", [6, 9])
def test_decontamination_tells_items_of_one_id_apart(spark, length):
    rnd = random.Random(6)
    items = [(i, " ".join(f"r{rnd.randrange(10**6)}" for _ in range(length))) for i in [None] * 30 + [1] * 10 + [2]]
    table = documents(spark, [(i, "x y " + text + " z") for i, (_, text) in enumerate(items)])
    found = decontaminate.leaks(table, benchmark(spark, items))
    assert listed(found, "doc_id", "item_id", "n", "shared") == sorted(((i, x, length - 4, length - 4) for i, (x, _) in enumerate(items)), key=repr)
    assert decontaminate.drop_contaminated(table, benchmark(spark, items)).count() == 0


def test_language(spark, sf_dir, docs):
    table = spark.read.parquet(f"{sf_dir}/documents.parquet")
    rows = language.identify(table).join(table.select("doc_id", "lang"), "doc_id").where("held_out").collect()
    assert len(rows) > 20 and sum(r["lang"] == r["lang_pred"] for r in rows) >= 0.95 * len(rows)
    odd = language.identify(docs).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 for r in odd)
    blank = {r["doc_id"] for r in docs.collect() if not any(c.isalpha() for c in r["text"] or "")}
    assert all((r["lang_pred"] == "und") == (r["doc_id"] in blank) for r in odd if r["doc_id"] not in (None, 3))
    assert {r["lang_pred"] for r in language.identify(docs.withColumn("lang", F.lit(None).cast("string"))).collect()} == {"und"}
    assert language.identify(empty(docs)).collect() == []
    assert all(r["held_out"] == (zlib.crc32(str(r["doc_id"]).encode()) % 4 == 2) for r in odd if r["doc_id"] is not None)


def test_language_does_not_depend_on_the_cut():
    text = "Grün und blau " * 50
    for run in (7, 100, 10_000):
        seen = []
        for codes, _, starts in language._runs([text, None, "x"], run):
            for order in language.ORDERS:
                seen += language._buckets(codes, order, 12)[starts].tolist()
        got = Counter(seen)
        assert run == 7 or got == first  # noqa: F821
        first = got


def test_quality(spark, sf_dir, docs):
    larger = f"{os.path.dirname(sf_dir)}/sf0.01"  # the smallest table has three bad rows held out
    table, labels = (spark.read.parquet(f"{larger}/{t}.parquet") for t in ("documents", "labels"))
    rows = quality.classify(table, labels).join(labels, "doc_id").where("held_out").collect()
    good, bad = ([r["predicted"] for r in rows if r["quality"] == q] for q in (1, 0))
    assert sum(good) >= 0.9 * len(good)
    assert not bad or sum(bad) <= 0.5 * len(bad)
    odd = quality.classify(docs, labels).collect()
    assert len(odd) == docs.count() and all(0 <= r["score"] <= 1 and r["predicted"] == (r["score"] >= 0.3) for r in odd)
    assert {r["score"] for r in quality.classify(docs, labels.where("false")).collect()} == {0.5}
    assert quality.classify(empty(docs), labels).collect() == []
    kept = quality.drop_rejected(docs, labels)
    assert kept.columns == docs.columns and kept.count() == sum(r["predicted"] for r in odd)


def plain_grams(text, bits=language.BITS):
    """Buckets of the 1-, 2- and 3-grams that start at each character, a blank before and two after."""
    folded = [ord(c.lower()[0]) if c.isalpha() else 32 for c in " " + text]
    out = []
    for at in range(len(folded)):
        for order in (1, 2, 3):
            h = order
            for k in range(order):
                c = folded[at + k] if at + k < len(folded) else 32
                h = (h ^ c) * (0x9E3779B1, 0x85EBCA77, 0xC2B2AE3D)[k] % 2**32
                h ^= h >> 15
            out.append(h >> (32 - bits))
    return out


def test_language_against_plain_bayes(spark):
    rnd = random.Random(8)
    sounds = {"xa": "aeiou", "xb": "äöüst", "xc": "日本語のは"}
    rows = [(i, "".join(rnd.choice(sounds[lang] + "n r") for _ in range(rnd.randint(1, 30))), lang) for i, lang in enumerate(rnd.choices([*sounds], k=60))]
    rows += [(100, "", "xa"), (101, None, "xb"), (102, "no label", None), (103, "12 ,", "xc"), (7, "twice", "xa"), (7, "twice", "xa")]
    counts, docs_of = {x: Counter() for x in sounds}, Counter()
    for i, text, lang in rows:
        if zlib.crc32(str(i).encode()) % 4 != 2 and lang and text is not None:
            docs_of[lang] += 1
            counts[lang].update(plain_grams(text) if text else [])
    size = 2**language.BITS
    want = []
    for i, text, _ in rows:
        held_out = zlib.crc32(str(i).encode()) % 4 == 2
        if not any(c.isalpha() for c in text or ""):
            want.append((i, held_out, "und", 0.0))
            continue
        logs = {}
        for lang, seen in counts.items():
            total = sum(seen.values()) + language.SMOOTHING * size
            logs[lang] = np.log(docs_of[lang] / sum(docs_of.values())) + sum(np.log((seen[b] + language.SMOOTHING) / total) for b in plain_grams(text))
        best = max(sorted(logs), key=logs.get)
        want.append((i, held_out, best, 1 / sum(np.exp(v - logs[best]) for v in logs.values())))
    got = language.identify(spark.createDataFrame(rows, "doc_id long, text string, lang string")).collect()
    got, want = sorted(tuple(r) for r in got), sorted(want)
    assert [r[:3] for r in got] == [r[:3] for r in want]
    assert np.allclose([r[3] for r in got], [r[3] for r in want], atol=1e-3)


def plain_pool(text, contexts):
    """The document vector, word by word."""
    size = quality.DIMENSIONS
    words, out = (text or "").split(), np.zeros(2 * size)
    hashes = [zlib.crc32(w.encode()) for w in words]
    for w, h in zip(words, hashes, strict=True):
        out[:size] += contexts[h % (quality.ROWS - 1) + 1] / len(words)
        kind = re.sub(r"(.)\1+", r"\1", "".join("0" if c.isdigit() else ("A" if c.isupper() else "a") if c.isalpha() else c for c in w))
        out[size:] += quality.index_vector(f"shape {zlib.crc32(kind.encode()) % quality.SHAPES}") / len(words)
    if words:
        triples, lines = list(zip(words, words[1:], words[2:], strict=False)), text.split("\n")
        out[size:] += quality.index_vector("triple seen") * (len(triples) - len(set(triples))) / len(words)
        out[size:] += quality.index_vector("line seen") * (1 - len(set(lines)) / len(lines))
    return out


def test_quality_against_plain_python(spark, docs, monkeypatch):
    monkeypatch.setattr(quality, "STEP", 1000)
    texts = [r["text"] for r in docs.collect()]
    sums = np.zeros((quality.ROWS, quality.DIMENSIONS))
    for text in texts:
        words = (text or "").split()
        rows = [zlib.crc32(w.encode()) % (quality.ROWS - 1) + 1 for w in words]
        for i, row in enumerate(rows):
            for j in range(max(0, i - quality.REACH), min(len(rows), i + quality.REACH + 1)):
                if j != i:
                    sums[row] += quality.index_table()[rows[j]]
    contexts = sums / np.maximum(1, np.linalg.norm(sums, axis=1))[:, None]
    assert not quality.index_table()[0].any() and quality.index_table()[1:].any(axis=1).all()
    for parts in (1, 5):
        assert np.allclose(quality.word_vectors(docs.repartition(parts)), contexts, atol=1e-6)
    labels = spark.createDataFrame([(i, i % 2) for i in range(45)] + [(3, 0), (3, 1), (3, None), (None, 1), (99, 1)], "doc_id long, quality int")
    vectors, net = quality.fit(docs, labels)
    for r in quality.score(docs, (vectors, net), ["text"]).collect():
        x = (plain_pool(r["text"], contexts) - net["mean"]) / net["std"]
        hidden = [max(0.0, sum(a * w for a, w in zip(x, column, strict=True)) + b) for column, b in zip(net["w1"].T, net["b1"], strict=True)]
        out = sum(a * w for a, w in zip(hidden, net["w2"], strict=True)) + net["b2"]
        assert abs(r["score"] - 1 / (1 + np.exp(-out / net["temperature"]))) < 1e-3


def test_quality_sample_is_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(quality, "fit_network", lambda x, y, seed=7: seen.append((len(x), sorted(set(y)))) or {"constant": 0.5})
    ids = [i for i in range(40) if zlib.crc32(str(i).encode()) % 5]
    rows = [(ids[0], f"text {i}") for i in range(50)] + [(ids[1], "same text")] * 50 + [(i, f"own {i}") for i in ids[2:]]
    table = spark.createDataFrame(rows, "doc_id long, text string")
    labels = spark.createDataFrame([(i, n % 2) for n, i in enumerate(ids)] * 2, "doc_id long, quality int")
    quality.fit(table, labels)
    quality.fit(table, labels, most=20)
    assert seen[0][0] == 50 + 1 + len(ids) - 2 and seen[1][0] <= 20


def pages(spark, rows):
    return spark.createDataFrame(rows, "page_id long, url string, html string")


def test_archive_round_trip(spark, tmp_path):
    big, small = "<p>" + "long text " * 40 + "</p>", "tiny"
    rows = [(3, "http://a/1", big), (1, "http://a/2", big), (2, None, big), (2, None, big), (None, "http://a/3", big), (4, "u\r\nX: y", small)]
    rows += [(5, "u", small), (6, "u", None), (7, "u", ""), (8, "u", "é" * 60), (9, "v", "é" * 60), (None, "w", "ö" * 80), (None, "w", "ö" * 80)]
    table = pages(spark, rows)
    archive.write_archive(table, f"file://{tmp_path}/warc")
    got = archive.read_archive(spark, f"file://{tmp_path}/warc").collect()
    want = []
    for i, _, html in rows:
        raw = (html or "").encode()
        low = min((j for j, _, h in rows if (h or "").encode() == raw and j is not None), default=None)
        again = len(raw) >= 100 and low is not None and i != low
        want.append((i, len(raw), hashlib.sha256(raw).hexdigest(), "revisit" if again else "response", low if again else None))
    names = ("page_id", "payload_bytes", "payload_digest", "record_type", "refers_to")
    assert sorted((tuple(r[c] for c in names) for r in got), key=repr) == sorted(want, key=repr)
    once = spark.read.parquet(f"file://{tmp_path}/warc/payloads")
    assert once.count() == len({(h or "") for _, _, h in rows})
    for r in got:
        record = bytes(r["record"])
        assert record.startswith(b"WARC/1.1\r\nWARC-Type: ") and record.endswith(b"\r\n\r\n")
        head, _, block = record.partition(b"\r\n\r\n")
        assert int(re.search(rb"\r\nContent-Length: (\d+)", head)[1]) == len(block) - 4
        if r["record_type"] == "response":
            assert hashlib.sha256(block.partition(b"\r\n\r\n")[2][:-4]).hexdigest() == r["payload_digest"]
    assert listed(archive.archived(table), *names) == sorted(want, key=repr)
    assert archive.archived(table.where("false")).collect() == []


def test_common_subsequence():
    rnd = random.Random(6)
    for _ in range(300):
        a, b = ([rnd.randint(0, 5) for _ in range(rnd.randint(0, 12))] for _ in range(2))
        table = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i, x in enumerate(a):
            for j, y in enumerate(b):
                table[i + 1][j + 1] = table[i][j] + 1 if x == y else max(table[i][j + 1], table[i + 1][j])
        found = sorted(pagetext.common_subsequence(a, b))
        assert len(found) == table[-1][-1]
        at = 0
        for i in found:
            at = b.index(a[i], at) + 1


def test_page_text(spark):
    frame = "<div>Site name</div><div>Contact us</div>"
    bare = lambda x: f"<html><body>{frame}<p>{x}</p><div>End of page</div></body></html>"
    rows = [
        (1, "http://h/a/1", bare("first story")),
        (2, "http://h/a/2", bare("second story")),
        (3, "http://h/a/2", bare("second story")),
        (4, "http://other/x", bare("alone")),
        (5, None, None),
        (6, "http://h/z", ""),
        (7, "http://h/b", "<nav><ul><li>Menu</ul></nav><article><header><h1>Title</h1></header><p>One&nbsp;&amp; <b>tw</b>o<br>three<p>four<div class='share'>Share</div><script>x<p>y</script><form>f</form><section class=comments><p>c</p></section></article><footer>&copy;</footer>"),
        (8, "http://h/c", "<main><p>Same</p></main><div class='cookie-notice'>We use</div>"),
        (9, "http://h/c", "<main><p>Same</p></main><div class='cookie-notice'>We use</div>"),
        (10, "http://h/d", "plain < text > here <!-- no --> end"),
        (11, "http://h/e", "<aside>side</aside>" + "<p>" + "very long " * 20_000),
    ]
    got = {r["page_id"]: r["text"] for r in pagetext.main_text(pages(spark, rows)).collect()}
    assert got[1] == "first story"
    assert got[2] == got[3] == "Site name Contact us second story End of page" or got[2] == "second story"
    assert got[4] == "Site name Contact us alone End of page"
    assert got[5] == got[6] == ""
    assert got[7] == "Title One & two three four"
    assert got[8] == got[9] == "Same"
    assert got[10] == "plain < text > here end"
    assert got[11] == ("very long " * 20_000).strip()
    assert all(r["n_chars"] == len(r["text"]) for r in pagetext.main_text(pages(spark, rows)).collect())
    assert pagetext.main_text(pages(spark, [])).collect() == []


@pytest.mark.parametrize("partitions", [1, 7])
def test_page_text_of_copies_and_near_copies(spark, partitions, monkeypatch):
    """Runs of copies and near-copies take their frame from the next different page."""
    def page(*body):
        return "<div>The name of the site</div>" + "".join(f"<p>{x}</p>" for x in body) + "<div>All about us</div>"

    long = [f"{i}th sentence of a story that is told on more than one page" for i in range(12)]
    rows = [(i, f"http://h/a/{i:02}", page(*long)) for i in range(5)]
    rows += [(i, f"http://h/a/{i:02}", page(*long, f"changed {i}")) for i in range(5, 12)]
    rows += [(20, "http://h/b", page("A quite different text that stands here", "and has a second line"))]
    rows += [(30 + i, f"http://one/{i}", page(*long, f"changed {i}")) for i in range(3)]
    rows += [(40 + i, f"http://two/{i}", page(*long)) for i in range(2)]
    by_range = type(pages(spark, [])).repartitionByRange  # a number keeps the planner from joining small partitions
    monkeypatch.setattr(type(pages(spark, [])), "repartitionByRange", lambda df, *order: by_range(df, partitions, *order))
    got = {r["page_id"]: r["text"] for r in pagetext.main_text(pages(spark, rows)).collect()}
    story = " ".join(long)
    want = {i: story for i in range(5)} | {i: f"{story} changed {i}" for i in range(5, 12)}
    want[20] = "A quite different text that stands here and has a second line"
    framed = lambda x: f"The name of the site {x} All about us"
    want |= {30 + i: framed(f"{story} changed {i}") for i in range(3)} | {40 + i: framed(story) for i in range(2)}
    assert got == want


def test_page_text_of_the_test_pages(spark, sf_dir):
    import html

    table = spark.read.parquet(f"{sf_dir}/pages.parquet")

    def expected(page):
        inner = re.search(r"<article>(.*?)</article>", page, re.S)[1]
        inner = re.sub(r"<[^>]+>", "", re.sub(r"</?(p|br|h1)\b[^>]*>", " ", inner))
        return " ".join(html.unescape(inner).split())

    got = {r["page_id"]: r["text"] for r in pagetext.main_text(table).collect()}
    assert got == {r["page_id"]: expected(r["html"]) for r in table.collect()}
