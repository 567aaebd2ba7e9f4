"""Rows that a shortcut would lose: other lengths, missing ids, passages of very many items, texts with special tokens."""

import collections
import itertools
import random
import time
import urllib.parse

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from finmart.llm import decontaminate, embedding_dedup, jaccard_join, packing, sharding, warc
from finmart.llm.tokens import Encoder


def test_vectors_link_with_their_own_length(spark):
    held = [(1, [1.0, 2.0]), (2, [1.0, 2.0]), (3, [2.0, 4.0]), (4, [1.0, 2.0, 3.0]), (5, [1.0, 2.0, 3.0]), (6, [1.0]), (7, None),
            (8, [0.0, 0.0, 0.0]), (9, [5.0])]
    df = spark.createDataFrame(held, "vec_id long, embedding array<double>")
    got = {r["vec_id"]: (r["n_links"], r["component_id"], r["kept"]) for r in embedding_dedup.near_duplicates(df).collect()}
    assert got == {1: (2, 1, True), 2: (2, 1, False), 3: (2, 1, False), 4: (1, 4, True), 5: (1, 4, False), 6: (1, 6, True),
                   7: (0, 7, True), 8: (0, 8, True), 9: (1, 6, False)}


def test_windows_of_items_without_an_id_hit(spark):
    text = " ".join(f"w{i}" for i in range(12))
    docs = spark.createDataFrame([(1, text), (2, "clean words only"), (3, "x " + text)], "doc_id long, text string")
    benchmark = spark.createDataFrame([(None, text), (7, "w0 w1 w2 w3 w4 w5 w6 w7 w8 w9 other"), (None, None)], "item_id long, text string")
    for slice_bytes in (1 << 20, 30):
        found = decontaminate.scan(docs, benchmark, slice_bytes=slice_bytes)
        got = {r["id"]: tuple(r)[1:4] for r in decontaminate.report(found).collect()}
        assert got == {1: (12, 12, 1), 2: (3, 0, 0), 3: (13, 12, 1)}
    assert [r["doc_id"] for r in decontaminate.remove(docs, benchmark).collect()] == [2]


def test_passage_of_very_many_items():
    passage = " ".join(f"w{i}" for i in range(12)).encode()
    items = [(str(i), passage + f" own{i}".encode()) for i in range(20_000)]
    index = decontaminate.Index(items, 10)
    words = passage.split()
    hashed = decontaminate.WordHashes().of(words)
    start = time.perf_counter()
    hit, found = index.hits(words, hashed)
    assert hit.all() and found == set(range(20_000)) and time.perf_counter() - start < 0.05


def test_equal_hashes_of_unequal_windows(monkeypatch):
    monkeypatch.setattr(decontaminate, "ngram_hashes", lambda hashed, n: np.zeros(max(0, len(hashed) - n + 1), np.uint64))
    index = decontaminate.Index([("a", b"x y"), ("b", b"z q"), ("c", b"X, Y"), ("d", b"p q")], 10)
    words = b"k x y z".split()
    hit, found = index.hits(words, decontaminate.WordHashes().of(words))
    assert hit.tolist() == [False, True, True, False] and found == {0, 2}


def test_documents_without_an_id_link(spark):
    words = [f"w{i}" for i in range(60)]
    one, near, other = " ".join(words), " ".join(words[:59]), " ".join(f"o{i}" for i in range(60))
    df = spark.createDataFrame([(5, one), (None, near), (None, other), (None, other), (9, "alone here"), (None, None)], "doc_id long, text string")
    got = sorted(((r["id"], r["n_shingles"], r["component_id"], r["n_links"]) for r in jaccard_join.similar_documents(df).collect()), key=str)
    assert got == sorted([(5, 57, 5, 1), (None, 56, 5, 1), (None, 57, None, 1), (None, 57, None, 1), (9, 1, 9, 0), (None, 0, None, 0)], key=str)


@pytest.mark.parametrize("name", ["byte_bpe_50k.json", "word_bpe_49k.json"])
def test_ids_are_those_of_the_plain_call(name):
    plain = Tokenizer.from_file(public_tokenizers.path(name))
    texts = ["a <|endoftext|> b", "A <|ENDOFTEXT|> b", "x<|startoftext|>", "plain <| text |>", "", "usual words here", "<|endoftext|>" * 3]
    got = Encoder(name).encode([t.encode() for t in texts])
    assert [np.frombuffer(ids, "<u4").tolist() for ids in got] == [plain.encode(t, add_special_tokens=False).ids for t in texts]


def test_spans_do_not_depend_on_slices(spark):
    words = [f"v{i}" for i in range(40)]
    text = "Front, " + ", ".join(words) + " end"
    docs = spark.createDataFrame([(1, text, "a"), (1, text, "a"), (None, "clean", None), (3, None, "c"), (4, "", "d"), (5, "v0 v1", "e")],
                                 "doc_id long, text string, _row string")
    benchmark = spark.createDataFrame([(1, " ".join(words[6:18])), (2, " ".join(words[12:24]))], "item_id long, text string")
    whole, sliced = (sorted(map(tuple, decontaminate.remove(docs, benchmark, spans=True, slice_bytes=b).collect()), key=str)
                     for b in (1 << 20, 30))
    assert whole == sliced and (5, "v0 v1", "e") in whole
    assert (1, "Front, " + ", ".join(words[:6]) + ", , " + ", ".join(words[24:]) + " end", "a") in whole
    assert [sorted(r["doc_id"] or 0 for r in decontaminate.remove(docs, benchmark, slice_bytes=b).collect()) for b in (1 << 20, 30)] == [[0, 3, 4, 5]] * 2


def test_every_record_is_stored_in_its_shard(spark, tmp_path):
    held = [(None, "x", 1, "p"), (1, "y", 2, "q"), (1, "y", 3, "r"), (2, None, 4, None), (3, "", 5, "s"), (4, "long " * 500, 6, "t")]
    df = spark.createDataFrame(held, "doc_id long, text string, shard int, row string")
    path = f"file://{tmp_path}/shards"
    sharding.write_shards(df, path, shards=3)
    got = spark.read.parquet(path)
    assert got.columns == ["doc_id", "text", "shard_", "row", "slot", "shard"]
    assert sorted(map(tuple, got.select("doc_id", "text", "shard_", "row").collect()), key=str) == sorted(held, key=str)
    slots = {}
    for r in got.collect():
        slots.setdefault(r["shard"], []).append(r["slot"])
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())


@pytest.mark.parametrize("piece", ["<a ", "<p ", "<a", "<title>", "<script ", "<!DOCTYPE ", "<a href='", "</script "])
def test_long_hostile_pages(piece):
    block = b"HTTP/1.1 200 OK\r\n\r\n" + (piece * (1_000_000 // len(piece))).encode()
    start = time.perf_counter()
    warc.derived(warc.Fields({"warc-record-id": "x", "warc-date": "d"}), block)
    assert time.perf_counter() - start < 5


def test_pages_are_read_as_by_one_pattern():
    page = "a<!-- <p> -->b<script x>if (1 > 0) </SCRIPT >c<style>d</style><!doctype html>e<p class='k'>f<br>g<script"
    assert warc.shown(page) == "abce<p class='k'>f<br>g<script"
    assert warc.plain_text(warc.shown(page)) == "abce\nf\ng<script"
    assert warc.shown("a<!-- b") == "a" and warc.shown("a<style>b > c") == "a" and warc.shown("x < y <script-z>q") == "x < y "
    assert warc.page_title("<titles><TITLE id=1> A\n&amp; B</title ></title>") == "A & B"
    assert warc.page_title("<title>open") is None and warc.page_title("none") is None
    page = "<a name=x><a\thref = 'q>r'><a HREF=/s?t&amp;u>v<abbr href=no><a title='w' href=\"\"><a data-href=z"
    assert warc.links(page, "http://h/d") == ["http://h/q>r", "http://h/s?t&u", "http://h/d", "http://h/z"]


def test_heads_of_other_writers():
    head = b"WARC/1.0\r\nwarc-type:response\r\nWARC-RECORD-ID: <urn:x>\r\nContent-length:  3\r\n"
    fields = warc.head_fields(head)
    assert (fields["WARC-Type"], fields.get("WARC-Record-ID"), "Content-Length" in fields) == ("response", "<urn:x>", True)
    assert warc.parsed(head + b"\r\nabc\r\n\r\n")[1:3] == ("<urn:x>", "response")


def test_fillings_are_all_the_undominated_ones():
    """Against all fillings, compared two by two: pieces of one that take the places of one or several pieces of the other."""
    def stands_for(better, worse):
        if not worse:
            return True
        if not better:
            return False
        first, rest = better[0], better[1:]
        for mask in range(1 << len(worse)):
            taken = [x for i, x in enumerate(worse) if mask >> i & 1]
            if sum(taken) <= first and stands_for(rest, [x for i, x in enumerate(worse) if not mask >> i & 1]):
                return True
        return False

    rng = random.Random(5)
    for counts, room in [({k: 3 for k in range(1, 7)}, 9), ({k: 1 for k in range(1, 9)}, 13),
                         *(({rng.randint(1, 9): rng.randint(1, 2) for _ in range(5)}, rng.randint(3, 12)) for _ in range(30))]:
        pieces = [length for length, n in counts.items() for _ in range(n)]
        every = {tuple(sorted(c, reverse=True)) for n in range(len(pieces) + 1) if n <= 6
                 for c in itertools.combinations(pieces, n) if sum(c) <= room}
        best = {f for f in every if not any(g != f and stands_for(list(g), list(f)) for g in every)}
        got, whole = packing._fillings(sorted(counts, reverse=True), counts, room, room, 10 ** 6)
        assert whole and len(got) == len(set(got)) and set(got) <= every
        assert best <= set(got), (counts, room)
    assert packing._fillings([6, 5, 4, 3, 2, 1], {k: 3 for k in range(1, 7)}, 9, 9, 10 ** 6) == ([(6, 3), (5, 4)], True)


def test_a_cut_enumeration_gives_up_no_branch():
    counts = collections.Counter(random.Random(4).randint(20, 60) for _ in range(300))
    for limit in (0, 1, 5):
        runs = packing.plan(counts, 100, branches=50, limit=limit)
        used = collections.Counter()
        for filling, times in runs:
            assert sum(filling) <= 100
            for length in filling:
                used[length] += times
        assert used == counts


def test_addresses_are_those_of_the_plain_join():
    bases = ["http://h.org/d/e", "https://h.org", "http://h.org:80/d", "HTTP://H.org/d", "", "ftp://h/d", "http://h.org?q"]
    targets = ["/a", "/a/", "/a/b-c_d", "/a/../b", "/a//b", "/", "//o/x", "http://o.org", "http://o.org/", "https://o.org/a/b", "http://o.org/a/../b",
               "http://O.org/a", "b", "?q", "#f", "/a?b", "mailto:x"]
    for base in bases:
        for target in targets:
            assert warc.links(f'<a href="{target}">', base) == [t for t in [urllib.parse.urljoin(base, target)] if t], (base, target)
