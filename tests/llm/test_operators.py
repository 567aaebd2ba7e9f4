"""Each operator against a brute-force version on small awkward tables."""

import collections
import hashlib
import math
import random
import re
import zlib

import numpy as np
import pytest
from pyspark.sql import functions as F

from finmart.llm import (
    decontaminate,
    embedding_dedup,
    jaccard_join,
    licenses,
    lm_score,
    packing,
    quality,
    sharding,
    token_store,
    tokens,
    warc,
)
from finmart.llm.components import components
from finmart.llm.tokens import Encoder

WORDS = "the of and a Tree house É größe 12 mit license under version apache cc by nc".split()
# clashing names: id, row, n, text_crc32 and label are names the operators use inside
SCHEMA = "doc_id long, text string, lang string, id string, row string, n int, label int, text_crc32 string"


def prose(rng, n):
    return " ".join(rng.choice(WORDS) for _ in range(n))


@pytest.fixture(scope="module")
def rows():
    rng = random.Random(5)
    base = [prose(rng, rng.randint(1, 200)) for _ in range(30)]
    texts = [*base, *base[:5], base[0], None, "", "   \n", "...", prose(rng, 30_000)]
    for text in base[:10]:
        words = text.split()
        words[len(words) // 2] = "changed"
        texts.append(" ".join(words))
    texts += ["x " + prose(rng, 60) + " Under the MIT license, and under the mit-license. CC-BY-NC", "\x00 apache License, Version 2!"]
    return [(i, t, "en", "x", "y", 1, 2, "z") for i, t in enumerate(texts)]


@pytest.fixture(scope="module")
def docs(spark, rows):
    return spark.createDataFrame(rows, SCHEMA).repartition(3)


@pytest.fixture(scope="module")
def empty(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="module")
def odd(spark):
    """Missing and repeated ids, repeated rows."""
    held = [(None, "a b c d e"), (None, None), (1, "a b c d e"), (1, "a b c d e"), (1, "other words stand here"), (2, "a b c d e")]
    return spark.createDataFrame([(*h, "en", "x", "y", 1, 2, "z") for h in held], SCHEMA)


def alnum(text):
    return re.findall(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def test_components(spark):
    rng = random.Random(1)
    edges = [(rng.randrange(300), rng.randrange(300)) for _ in range(200)] + [(1000, i) for i in range(1001, 1100)]
    edges += [(i, i + 1) for i in range(2000, 2060)] + [(None, 5), (7, 7)]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in (e for e in edges if None not in e):
        a, b = sorted((find(a), find(b)))
        root[b] = a
    got = {r["node"]: r["root"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert got == {x: find(x) for x in root}
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_embeddings(spark):
    rng = np.random.default_rng(2)
    centres = rng.standard_normal((12, 16))
    vectors = [c + 0.08 * rng.standard_normal(16) for c in centres for _ in range(25)]
    vectors += [vectors[0]] * 40 + [vectors[0] * 3.0] + [1e200 * vectors[1]]
    held = [(i, v.tolist()) for i, v in enumerate(vectors)]
    n = len(held)
    held += [(n, None), (n + 1, [0.0] * 16), (n + 2, [float("nan")] * 16), (n + 3, [None] + [1.0] * 15), (n + 4, []), (n + 5, [1.0])]
    df = spark.createDataFrame(held, "vec_id long, embedding array<double>").withColumn("unit", F.lit(1)).withColumn("node", F.lit("x"))
    got = {r["vec_id"]: r for r in embedding_dedup.near_duplicates(df).collect()}
    unit = np.array(vectors) / np.abs(vectors).max(1, keepdims=True)
    unit /= np.linalg.norm(unit, axis=1, keepdims=True)
    linked = unit @ unit.T >= 0.95
    np.fill_diagonal(linked, False)
    assert [got[i]["n_links"] for i in range(n)] == linked.sum(1).tolist()
    least = np.arange(n)
    for _ in range(n):
        least = np.minimum(least, np.where(linked, least[None, :], n).min(1))
    assert [got[i]["component_id"] for i in range(n)] == least.tolist()
    assert all(got[i]["kept"] == (got[i]["component_id"] == i) for i in got)
    assert [(got[i]["n_links"], got[i]["kept"]) for i in range(n, n + 6)] == [(0, True)] * 6
    assert embedding_dedup.near_duplicates(df.limit(0)).count() == 0


def test_full_buckets_lose_no_link(spark, monkeypatch):
    monkeypatch.setattr(embedding_dedup, "BLOCK_ROWS", 16)
    rng = np.random.default_rng(3)
    vectors = np.ones(8) + 0.12 * rng.standard_normal((150, 8))
    df = spark.createDataFrame([(i, v.tolist()) for i, v in enumerate(vectors)], "vec_id long, embedding array<double>")
    unit = vectors / np.linalg.norm(vectors, axis=1, keepdims=True)
    want = (unit @ unit.T >= 0.95).sum(1) - 1
    got = {r["vec_id"]: r["n_links"] for r in embedding_dedup.near_duplicates(df).collect()}
    assert all(got[i] <= want[i] for i in got) and sum(got.values()) >= 0.98 * want.sum()


def test_shards(spark, docs, rows, empty, odd):
    got = sharding.shard_by_bytes(docs, 5, ranges_per_shard=8).collect()
    assert {(r["id"], r["size"], r["text_crc32"]) for r in got} == {
        (i, len((t or "").encode()) + 8, zlib.crc32((t or "").encode())) for i, t, *_ in rows}
    slots = collections.defaultdict(list)
    for r in got:
        slots[r["shard"]].append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    # equal rows: sizes differ by one row
    many = spark.range(5000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"))
    sizes = sharding.shard_by_bytes(many, 24, ranges_per_shard=8).groupBy("shard").count().collect()
    assert len(sizes) == 24 and max(r["count"] for r in sizes) - min(r["count"] for r in sizes) <= 1
    assert sharding.shard_by_bytes(empty, 5).count() == 0
    assert sharding.shard_by_bytes(odd, 2, ranges_per_shard=2).count() == 6


@pytest.mark.parametrize("slice_bytes", [1 << 20, 60])
def test_decontamination(spark, docs, rows, empty, slice_bytes):
    texts = [t for _, t, *_ in rows]
    items = [(1, " ".join(texts[3].split()[:14])), (2, "House mit Licence"), (3, "tree, house"), (4, None), (5, ""), (10, " ".join(texts[7].split()[-11:]))]
    benchmark = spark.createDataFrame(items, "item_id long, text string")
    windows = collections.defaultdict(set)
    for name, text in items:
        words = alnum(text)
        n = min(10, len(words))
        for i in range(len(words) - n + 1 if words else 0):
            windows[tuple(words[i:i + n])].add(name)
    want = {}
    for i, text, *_ in rows:
        words, hit, found = alnum(text), set(), set()
        for n in {len(w) for w in windows}:
            for at in range(len(words) - n + 1):
                if names := windows.get(tuple(words[at:at + n])):
                    hit |= set(range(at, at + n))
                    found |= names
        want[i] = (len(words), len(hit), len(found), hashlib.sha256(",".join(sorted(map(str, found))).encode()).hexdigest(), bool(hit))
    got = decontaminate.report(decontaminate.scan(docs, benchmark, slice_bytes=slice_bytes)).collect()
    assert {r["id"]: tuple(r)[1:] for r in got} == want
    left = decontaminate.remove(docs, benchmark, slice_bytes=slice_bytes)
    assert left.columns == docs.columns and {r["doc_id"] for r in left.collect()} == {i for i in want if not want[i][4]}
    cut = decontaminate.remove(docs, benchmark, spans=True)
    assert cut.count() == len(rows) and not decontaminate.report(decontaminate.scan(cut, benchmark)).where("id = 3 AND n_hit > 9").count()
    assert decontaminate.scan(empty, benchmark).count() == 0
    assert decontaminate.scan(docs, benchmark.limit(0)).where("size(items) > 0").count() == 0


def test_language_model(spark, docs, rows, empty, odd):
    got = {r["id"]: r for r in lm_score.score_documents(docs).collect()}
    tokens = {i: (t or "").encode().lower().split() + [b""] for i, t, *_ in rows}
    held = {i: zlib.crc32(str(i).encode()) % 10 == 0 for i in tokens}
    counts = collections.Counter(w for i in tokens if not held[i] for w in tokens[i])
    total, kinds = sum(counts.values()), len(counts)
    for i, words in tokens.items():
        base = sum(math.log10((counts[w] + 0.1) / (total + 0.1 * (kinds + 1))) for w in words)
        r = got[i]
        assert (r["held_out"], r["n_tokens"], r["n_known"], r["train_tokens"]) == (
            held[i], len(words), sum(counts[w] > 0 for w in words), total)
        assert r["base_score"] == pytest.approx(base) and r["score"] < 0
    assert lm_score.score_documents(empty).count() == 0 and lm_score.score_documents(odd).count() == 6


def test_language_model_learns(spark):
    rng = random.Random(4)
    texts = []
    for i in range(400):
        word, out = "w0", []
        for _ in range(40):
            word = f"w{(int(word[1:]) * 3 + rng.randint(1, 3)) % 50}"
            out.append(word)
        texts.append((i, " ".join(out)))
    df = spark.createDataFrame(texts, "doc_id long, text string")
    model, _, losses = lm_score.train(df.select("text"))
    assert losses[-1] < 0.9 * losses[0]
    scored = lm_score.score_documents(df).where("held_out").agg(F.sum("score"), F.sum("base_score")).first()
    assert scored[0] > 0.8 * scored[1]
    # probabilities of all words and the end after any words add up to 1
    place = np.arange(model.vocabulary.rare)
    for context in (0, 77, 900):
        after = context // lm_score.SKIP
        sums = (10.0 ** (model.classes[context, model.vocabulary.class_of[place]] + model.words[after, place])).sum()
        assert sums + 10.0 ** model.classes[context, lm_score.CLASSES] == pytest.approx(1, abs=1e-3)


def test_licenses(spark, docs, rows, empty, odd):
    extra = [(900, "text. This work is licensed under the GNU General Public License, version 3 and more", *rows[0][2:]),
             (901, "gnu general license public version", *rows[0][2:])]
    got = {r["id"]: r for r in licenses.report(*licenses.scan(docs.unionByName(spark.createDataFrame(extra, SCHEMA)))).collect()}
    phrases = [("under the mit license", "mit"), ("apache license version 2", "apache-2"), ("cc by nc", "cc-by-nc")]
    for i, text, *_ in [*rows, *extra]:
        words, places, labels = alnum(text), [], set()
        for phrase, label in phrases:
            p = phrase.split()
            found = [at for at in range(len(words)) if words[at:at + len(p)] == p]
            places += found
            labels |= {label} if found else set()
        r = got[i]
        assert (r["n_words"], r["n_base"], r["first_word"], r["last_word"], r["base_labels"]) == (
            len(words), len(places), min(places, default=None), max(places, default=None), ",".join(sorted(labels)))
        assert labels <= set(r["labels"].split(",")) and 0 <= r["score"] <= 1
    assert got[900]["labels"] == "gpl-3" and got[901]["labels"] == ""
    assert licenses.report(*licenses.scan(empty)).count() == 0 and licenses.report(*licenses.scan(odd)).count() == 6


def jaccard_oracle(rows, words=4, percent=85):
    sets = {}
    for i, text, *_ in rows:
        w = (text or "").encode().lower().split()
        sets[i] = {tuple(w[k:k + words]) for k in range(len(w) - words + 1)} if len(w) >= words else {tuple(w)} if w else set()
    root, links = {i: i for i in sets}, collections.Counter()

    def find(x):
        while root[x] != x:
            x = root[x]
        return x

    ids = sorted(sets)
    for k, a in enumerate(ids):
        for b in ids[:k]:
            both = len(sets[a] & sets[b])
            if both and 100 * both >= percent * (len(sets[a]) + len(sets[b]) - both):
                links[a] += 1
                links[b] += 1
                x, y = sorted((find(a), find(b)))
                root[y] = x
    return {i: (len(sets[i]), find(i), links[i]) for i in sets}


@pytest.mark.parametrize("group_rows", [256, 2])
def test_jaccard(spark, rows, empty, odd, monkeypatch, group_rows):
    monkeypatch.setattr(jaccard_join, "GROUP_ROWS", group_rows)
    monkeypatch.setattr(jaccard_join, "FREQUENT", 64 if group_rows > 2 else 1)
    rng = random.Random(9)
    family = prose(rng, 300).split()
    more = []
    for i in range(40):
        words = list(family)
        for _ in range(rng.randint(0, 12)):
            words[rng.randrange(300)] = rng.choice(["one", "two", "three"])
        more.append((1000 + i, " ".join(words), *rows[0][2:]))
    every = [*rows, *more]
    got = jaccard_join.similar_documents(spark.createDataFrame(every, SCHEMA).repartition(3)).collect()
    assert {r["id"]: (r["n_shingles"], r["component_id"], r["n_links"]) for r in got} == jaccard_oracle(every)
    assert jaccard_join.similar_documents(empty).count() == 0
    assert jaccard_join.similar_documents(odd).count() == 6


def test_quality(spark, empty, odd):
    rng = random.Random(6)
    held, labels = [], []
    for i in range(300):
        bad = i % 4 == 0
        words = [rng.choice(WORDS) + ("%%%" if bad else "") for _ in range(rng.randint(30, 80))]
        held.append((i, " ".join(words), "en", "x", "y", 1, 2, "z"))
        labels.append((i, int(not bad)))
    held += [(900, None, *held[0][2:]), (901, "", *held[0][2:]), (902, prose(rng, 20_000), *held[0][2:])]
    labels += [(None, 1), (5, None), (77_777, 1), (9, 1)]
    known = spark.createDataFrame(labels, "doc_id long, quality int").withColumn("text", F.lit("?"))
    df = spark.createDataFrame(held, SCHEMA)
    space = quality.fit(df, known)
    got = {r["doc_id"]: r["score"] for r in quality.score(df, space).collect()}
    test = [i for i in range(300) if zlib.crc32(str(i).encode()) % 5 == 0]
    assert np.mean([(got[i] >= 0.3) == (i % 4 != 0) for i in test]) > 0.97
    assert all(0 <= s <= 1 for s in got.values()) and got[900] == pytest.approx(got[901])
    unfitted = quality.fit(empty, known.limit(0))
    assert {r["score"] for r in quality.score(odd, unfitted).collect()} == {0.5}
    # exact neighbours: the votes are those of a plain search
    some = [quality.features(t.encode()) for _, t, *_ in held[:50]]
    near = space.unit(some) @ space.known.T
    for row, vote in zip(near, space.votes(some)):
        best = np.argsort(-row, kind="stable")[:quality.NEIGHBOURS]
        weight = np.maximum(row[best], 0).astype(float) ** 8
        assert vote == pytest.approx((weight @ space.labels[best] + 1e-3 * space.prior) / (weight.sum() + 1e-3), abs=0.05)


def test_warc(spark):
    page = '<html><head><title>A &amp; B</title><style>p{}</style></head><body><script>var t="</p>";</script><p>One  <b>two</b></p><!-- x -->' \
           'three<br>four &lt;five&gt;<a class=k href="/x?a=1&amp;b=2">l</a><a href=\'http://o.org/\'>o</a><a href="/x?a=1&amp;b=2">again</a></body></html>'
    held = [(1, "http://h.org/d/", page), (2, None, page), (3, "http://h.org/e", None), (4, "http://[bad", "<a href=x>y"), (None, "http://h.org/", ""),
            (1, "http://h.org/d/", page), (5, "http://h.org/long", "<p>word</p>" * 50_000)]
    df = spark.createDataFrame(held, "page_id long, url string, html string").withColumn("head", F.lit(1)).repartition(2)
    folder, files = warc.write_warc(warc.responses(df), file_bytes=2000)
    assert files.agg(F.sum("records")).first()[0] == 7
    sources = warc.read_warc(folder, files)
    folder, files = warc.write_warc(warc.derivatives(sources))
    records = warc.read_warc(folder, files).collect()
    assert len(records) == 14
    origin = {r["record_id"]: r for r in sources.collect()}
    for r in records:
        source, fields = origin[r["refers_to"]], warc.head_fields(r["head"])
        told = warc.head_fields(source["head"])
        payload = source["block"].partition(b"\r\n\r\n")[2]
        assert fields["WARC-Source-Payload-Digest"] == told["WARC-Payload-Digest"] == warc.digest(payload)
        assert fields["WARC-Date"] == told["WARC-Date"] and fields.get("WARC-Target-URI") == told.get("WARC-Target-URI")
        assert fields["WARC-Block-Digest"] == warc.digest(r["block"])
    first = {r["kind"]: r["block"].decode() for r in records if r["source_id"] == 1}
    assert first["conversion"] == "A & B\nOne two\nthree\nfour <five>loagain"
    assert [x for x in first["metadata"].split("\r\n") if x.startswith(("title", "outlink"))] == [
        "title: A & B", "outlink: http://h.org/x?a=1&b=2", "outlink: http://o.org/"]
    assert warc.report(warc.read_warc(folder, files)).where("kind = 'metadata' AND n_links = 2").count() == 3
    assert warc.derivatives(warc.responses(df.limit(0))).count() == 0


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_chunks_give_the_ids_of_the_whole(name):
    rng = random.Random(8)
    parts = [" ", "  ", "\n", "\t", "\r\n", "a", "The", "'s", "don't", "é", "12", "..", "<|endoftext|>", "\x85", "\xa0", "\x1c", "é", "İ", "中", "🙂",
             "​", " ", "x" * 70, "\x00", "ﬁ"]
    texts = ["".join(rng.choices(parts, k=rng.randint(0, 25))).encode() for _ in range(4000)]
    encoder = Encoder(name)
    assert encoder.encode(texts) == encoder.encode_plain(texts)


def test_packing(spark, docs, rows, empty, odd):
    plain = Encoder("byte_bpe_50k.json").plain
    got = collections.defaultdict(list)
    for r in packing.pack(docs).collect():
        got[r["id"]].append(r)
    sequences = collections.defaultdict(list)
    for i, text, *_ in rows:
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 2]
        pieces = sorted(got[i], key=lambda r: r["piece"])
        assert [r["piece"] for r in pieces] == list(range(len(pieces)))
        assert [r["start"] for r in pieces] == [sum(q["length"] for q in pieces[:k]) for k in range(len(pieces))]
        assert [r["length"] for r in pieces] == [len(ids) % 1024 or 1024] + [1024] * (len(pieces) - 1) and sum(r["length"] for r in pieces) == len(ids)
        for r in pieces:
            assert r["ids_crc32"] == zlib.crc32(np.array(ids[r["start"]:r["start"] + r["length"]], "<u4").tobytes())
            sequences[r["sequence_id"]].append((r["offset"], r["length"]))
    for held in sequences.values():
        at = 0
        for offset, length in sorted(held):
            assert offset == at
            at += length
        assert at <= 1024
    assert packing.pack(empty).count() == 0 and packing.pack(odd).count() == 6


def test_plans_are_as_short_as_can_be():
    def fewest(pieces, size):
        best = [len(pieces)]

        def place(rest, rooms):
            if len(rooms) >= best[0]:
                return
            if not rest:
                best[0] = len(rooms)
                return
            for k in {r: k for k, r in enumerate(rooms) if r >= rest[0]}.values():
                place(rest[1:], [*rooms[:k], rooms[k] - rest[0], *rooms[k + 1:]])
            place(rest[1:], [*rooms, size - rest[0]])
        place(sorted(pieces, reverse=True), [])
        return best[0]

    rng = random.Random(3)
    over = 0
    for _ in range(60):
        pieces = [rng.randint(1, 20) for _ in range(rng.randint(1, 9))]
        counts = collections.Counter(pieces)
        runs = packing.plan(counts, 20)
        used = collections.Counter()
        for filling, times in runs:
            assert sum(filling) <= 20
            for length in filling:
                used[length] += times
        assert used == counts
        over += sum(t for _, t in runs) - fewest(pieces, 20)
    assert over <= 1
    assert packing.plan({}, 20) == []


def test_token_files(spark, docs, rows, empty, odd, folder):
    place = f"file://{folder}/tokens"
    path, manifest = token_store.write_tokens(docs, place, file_bytes=3000)
    got = sorted(token_store.read_tokens(path, manifest).collect())
    plain, start = Encoder("word_bpe_49k.json").plain, 0
    for (i, text, *_), r in zip(rows, got, strict=True):
        ids = [*plain.encode(text or "", add_special_tokens=False).ids, 1]
        assert tuple(r) == (i, start, len(ids), zlib.crc32(np.array(ids, "<u4").tobytes()))
        start += len(ids)
        if i in (3, 30, 33):
            assert token_store.read_document(spark, path, i) == [ids]
    assert manifest.count() > 1
    path, manifest = token_store.write_tokens(odd)
    assert sorted((r["id"] or -1) for r in token_store.read_tokens(path, manifest).collect()) == [-1, -1, 1, 1, 1, 2]
    path, manifest = token_store.write_tokens(empty)
    assert token_store.read_tokens(path, manifest).count() == 0


def test_remembered_ids(monkeypatch):
    """Ids put together from remembered chunks are those of whole texts, also while a small memory forgets."""
    monkeypatch.setattr(tokens, "MEMO_CHUNKS", 40)
    pieces = [" ", "  ", "\t", "\n", "\x0b", "\x1c", "\x85", " ", " ", "a", "B", "é", "漢", "İ", "ß", "a1b2", "Foo.bar",
              "x--y", "don't", "12,3.4", "<", "_", "\x7f", "\x00", "<|endoftext|>", "<|startoftext|>", "<|", "z" * 70]
    draw = random.Random(1)
    raws = ["".join(draw.choices(pieces, k=draw.randrange(30))).encode() for _ in range(1500)] + [b"", b" ", b"a" * 5000]
    for name in ("word_bpe_49k.json", "byte_bpe_50k.json"):
        encoder = tokens.Encoder(name)
        whole = encoder.encode_plain(raws)
        assert [ids for i in range(0, len(raws), 50) for ids in encoder.encode(raws[i:i + 50])] == whole
        assert encoder.encode(raws) == whole
    assert tokens.Encoder("word_bpe_49k.json").encode([]) == []
