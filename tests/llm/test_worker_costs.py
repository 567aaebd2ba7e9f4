"""What a worker keeps and does for a text: bounded memory, no detour for plain words and plain addresses."""

from urllib.parse import urljoin

import pyarrow as pa
import pytest

from finmart.llm import base, token_store, tokens, warc
from finmart.llm.tokens import Encoder


@pytest.fixture
def fresh(monkeypatch):
    """A worker that remembers nothing yet."""
    held = {}
    monkeypatch.setattr(tokens, "remembered", lambda name: held.setdefault(name, {}))


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_memory_of_chunks_is_bounded(monkeypatch, fresh, name):
    """However many words a block brings, those remembered are as many as was said."""
    monkeypatch.setattr(tokens, "MEMO_CHUNKS", 40)
    encoder = Encoder(name)
    raws = [" ".join(f"w{i}x{j}é" for j in range(200)).encode() for i in range(5)]
    assert encoder.encode(raws) == encoder.encode_plain(raws)
    kept = [memo for memo in encoder.held.values() if isinstance(memo, (dict, tokens.Memo))]
    sizes = [len(memo) if isinstance(memo, dict) else len(memo.young) + len(memo.old) for memo in kept]
    assert sizes and max(sizes) <= 40


def test_words_behind_a_blank_need_no_mark(monkeypatch, fresh):
    encoder, marked = Encoder("byte_bpe_50k.json"), []
    learn = Encoder._learn
    monkeypatch.setattr(Encoder, "_learn", lambda self, parts, *rest: marked.extend(parts) or learn(self, parts, *rest))
    raws = ["One für, l'été. Next\nline <| x".encode(), b"two "]
    assert encoder.encode(raws) == encoder.encode_plain(raws)
    assert set(marked) <= {b"One", b"two", b" "}


def test_accented_words_need_no_mark(monkeypatch, fresh):
    encoder, marked = Encoder("word_bpe_49k.json"), []
    learn = Encoder._learn
    monkeypatch.setattr(Encoder, "_learn", lambda self, parts, *rest: marked.extend(parts) or learn(self, parts, *rest))
    letters = [chr(c) for c in range(0xC0, 0x100) if c not in (0xD7, 0xF7)]
    raws = [" ".join(["für", "été.", "ÀÉ1é2", *letters, *(f"x{c}9{c}y" for c in letters)]).encode()]
    assert encoder.encode(raws) == encoder.encode_plain(raws)
    assert not marked


def test_long_batches_are_encoded_in_parts():
    batch = pa.RecordBatch.from_arrays([pa.array([1, 2, 3, 4]), pa.array(["a b " * 10, None, "c d " * 10, ""])], names=["id", "text"])
    assert [b.num_rows for b in base.sliced([batch], most=40)] == [2, 2]
    assert [b.num_rows for b in base.sliced([batch.slice(0, 0)])] in ([], [0])
    text = "word and word " * 350_000
    big = pa.RecordBatch.from_arrays([pa.array([1, 2, 3]), pa.array([text] * 3)], names=["id", "text"])
    parts = list(token_store._encoded("word_bpe_49k.json", None, 1, 2)(iter([big])))
    assert len(parts) > 1 and sum(p.num_rows for p in parts) == 3


def test_addresses_with_letters_of_any_kind_are_joined_without_parsing(monkeypatch):
    base_url = "https://news.example/a/b"
    targets = ["/für", "/und.", "/ciónes/x.html", "/a,b/", "https://other.example/é.php"]
    page = "".join(f'<a href="{t}">x</a>' for t in targets)
    told = [urljoin(base_url, t) for t in targets]
    odd = ["/../x", "/./y", "/.z", "//host/p"]
    assert warc.links("".join(f'<a href="{t}">x</a>' for t in odd), base_url) == [urljoin(base_url, t) for t in odd]
    monkeypatch.setattr(warc, "urljoin", None)
    assert warc.links(page, base_url) == told
