"""Token ids by the tokenizers library, with the ids of a chunk of text remembered.

A tokenizer's rules never join text across the chunks used here, so a text's ids are its chunks' ids in a row. A text that
spells one of the vocabulary's own tokens, such as a special one, is encoded by itself, as the tokenizer does it.
"""

from __future__ import annotations

import os
import re
import sys
import types
from itertools import islice

import numpy as np
import public_tokenizers
import pyarrow as pa
import pyarrow.compute as pc
from tokenizers import Tokenizer

# What the byte-level splitter takes as white space.
_BLANK = ("\\t\\n\\x0b\\x0c\\r \\x85\\xa0\\u1680\\u2000\\u2001\\u2002\\u2003\\u2004\\u2005\\u2006\\u2007\\u2008\\u2009"
          "\\u200a\\u2028\\u2029\\u202f\\u205f\\u3000")
# A word with one blank before it, else a run of white space without its last character, else one more.
_CHUNK = re.compile(f" ?[^{_BLANK}]+|[{_BLANK}]+(?![^{_BLANK}])|[{_BLANK}]+")
# Where none of these occurs, every blank begins a chunk that reaches to the next blank.
_LONG_BLANKS = (b"  ", b"\n ", b"\t ", b"\r ", b"\x0b ", b"\x0c ", b"\xc2\x85", b"\xc2\xa0", b"\xe1\x9a\x80", b"\xe2\x80",
                b"\xe2\x81\x9f", b"\xe3\x80\x80")
# A special token of each vocabulary, which parts chunks that are encoded in one call.
_MARKS = {"byte_bpe_50k.json": "<|endoftext|>", "word_bpe_49k.json": "<|startoftext|>"}
# Words of these characters alone, and the parts into which the word vocabulary splits them. The last id of a
# part carries the suffix.
_SIMPLE = re.compile(rb"(?:[!-&(-;=-~]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+")
_PARTS, _SUFFIX = "[A-Za-zÀ-ÖØ-öø-ÿ]+|[0-9]|[^A-Za-z0-9À-ÖØ-öø-ÿ]+", "</w>"
# How the byte-level vocabulary writes a blank.
_BLANK_MARK = "Ġ"
# Chunks that a worker remembers in two ages, about 60 MB; the ids do not depend on it.
MEMO_CHUNKS = 300_000
# Longer chunks are not remembered.
MEMO_BYTES = 64
# Bytes of text whose chunks are looked up together.
BLOCK_BYTES = 6_000_000
# Chunks that the tokenizer is given in one call.
CALL_CHUNKS = 16_384


def remembered(name: str) -> dict:
    """A dict that lives as long as the worker process, over all its tasks."""
    module = sys.modules.setdefault("finmart_worker_memory", types.ModuleType("finmart_worker_memory"))
    return module.__dict__.setdefault(name, {})


def _runs(chunks: list[bytes]) -> list[list[bytes]]:
    """Chunks for one call each: the tokenizer's own record of a token takes far more than its id."""
    return [chunks[i:i + CALL_CHUNKS] for i in range(0, len(chunks), CALL_CHUNKS)]


class Memo:
    """Ids of chunks in two ages, so that chunks seen again outlive the many that are seen once."""

    def __init__(self):
        self.young: dict[bytes, bytes] = {}
        self.old: dict[bytes, bytes] = {}

    def of(self, chunks: list[bytes], learn) -> list[bytes]:
        """Ids of distinct chunks; ``learn(fresh, ids)`` puts those of the unknown ones into ``ids``."""
        if len(self.young) >= MEMO_CHUNKS // 2:
            self.young, self.old = {}, self.young
        found = list(map(self.young.get, chunks))
        missing = [c for c, ids in zip(chunks, found) if ids is None]
        ids = {c: self.old[c] for c in missing if c in self.old}
        fresh = [c for c in missing if c not in ids]
        if fresh:
            learn(fresh, ids)
        found = [ids[c] if held is None else held for c, held in zip(chunks, found)]
        space = max(0, MEMO_CHUNKS // 2 - len(self.young))
        self.young.update(islice(((c, raw) for c, raw in ids.items() if len(c) <= MEMO_BYTES), space))
        return found


class Encoder:
    """Ids of whole UTF-8 texts as little-endian 32-bit bytes.

    The byte-level vocabulary keeps blanks: its chunks are words with the blank before them, remembered as ``kept`` without
    it, and whatever else the general rule gives, remembered as ``heads``. The other drops blanks: its chunks are words.
    Each distinct chunk of a block is looked up once.
    """

    def __init__(self, name: str, path: str | None = None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task is one thread's work
        path = path or public_tokenizers.path(name)
        held = remembered(f"tokenizer {path}")
        if not held:
            held["plain"] = Tokenizer.from_file(path)
            held["own"] = [t.content.encode() for t in held["plain"].get_added_tokens_decoder().values()]
            held["kept"], held["heads"] = Memo(), Memo()
            vocabulary = held["plain"].get_vocab()
            held["first"], held["last"] = np.zeros((2, 1 + max(vocabulary.values())), bool)
            held["first"][[i for token, i in vocabulary.items() if token.startswith(_BLANK_MARK)]] = True
            held["last"][[i for token, i in vocabulary.items() if token.endswith(_SUFFIX)]] = True
        self.held = held
        self.plain, self.kept, self.heads = (held[k] for k in ("plain", "kept", "heads"))
        self.mark, self.blanks = _MARKS.get(name), name == "byte_bpe_50k.json"

    def encode_plain(self, texts: list[bytes]) -> list[bytes]:
        encoded = self.plain.encode_batch_fast([t.decode() for t in texts], add_special_tokens=False)
        return [np.array(e.ids, "<u4").tobytes() for e in encoded]

    def _row(self, text: str) -> np.ndarray:
        return np.array(self.plain.encode_batch_fast([text], add_special_tokens=False)[0].ids, "<u4")

    def _learn(self, parts: list[bytes], memo: dict[bytes, bytes]) -> None:
        """Chunks that spell no special token are encoded in runs, parted by the mark."""
        odd = [p for p in parts if b"<|" in p]
        memo.update(zip(odd, self.encode_plain(odd)))
        even = [p for p in parts if b"<|" not in p]
        for run in _runs(even):
            ids = self._row(self.mark.encode().join(run).decode())
            ends = [*np.flatnonzero(ids == self.plain.token_to_id(self.mark)).tolist(), len(ids)]
            raw, start = ids.tobytes(), 0
            for part, end in zip(run, ends, strict=True):
                memo[part] = raw[4 * start:4 * end]
                start = end + 1

    def _learn_kept(self, fresh: list[bytes], memo: dict[bytes, bytes]) -> None:
        """Chunks behind a blank: where only ids of words in a row begin with a blank, each such id begins a chunk."""
        for run in _runs([p for p in fresh if p and p == p.strip()]):
            ids = self._row((b" " + b" ".join(run)).decode())
            starts = np.flatnonzero(self.held["first"][ids])
            if len(starts) == len(run):  # else this vocabulary has another rule
                cuts = [*(4 * starts).tolist(), 4 * len(ids)]
                raw = ids.tobytes()
                memo.update(zip(run, (raw[start:end] for start, end in zip(cuts, cuts[1:]))))
        rest = [p for p in fresh if p not in memo]
        learned: dict[bytes, bytes] = {}
        self._learn([b" " + p for p in rest], learned)
        memo.update((p, learned[b" " + p]) for p in rest)

    def _learn_words(self, fresh: list[bytes], memo: dict[bytes, bytes]) -> None:
        """The ids of simple words are counted off from those of all in a row, the rest go by the mark."""
        for run in _runs([w for w in fresh if _SIMPLE.fullmatch(w)]):
            ids = self._row(b" ".join(run).decode())
            parts = np.cumsum(pc.count_substring_regex(pa.array(run, pa.binary()).cast(pa.string()), _PARTS).to_numpy())
            ends = np.flatnonzero(self.held["last"][ids]) + 1
            if len(ends) == parts[-1]:  # else this vocabulary has another rule
                cuts = [0, *(4 * ends[parts - 1]).tolist()]
                raw = ids.tobytes()
                memo.update(zip(run, (raw[start:end] for start, end in zip(cuts, cuts[1:]))))
        self._learn([w for w in fresh if w not in memo], memo)

    def _block(self, texts: list[bytes]) -> list[bytes]:
        whole = pa.array(texts, pa.binary()).cast(pa.string())
        lists = pc.split_pattern(whole, " ") if self.blanks else pc.ascii_split_whitespace(whole)
        coded = lists.values.dictionary_encode()
        chunks, chunk = coded.dictionary.cast(pa.binary()).to_pylist(), coded.indices.to_numpy()
        offsets = lists.offsets.to_numpy()
        if self.blanks:
            held = self.kept.of(chunks, self._learn_kept)
            # a text's first chunk has no blank before it
            first = list(dict.fromkeys(chunks[i] for i in chunk[offsets[:-1]].tolist()))
            place = {c: len(held) + i for i, c in enumerate(first)}
            chunk = chunk.copy()
            chunk[offsets[:-1]] = [place[chunks[i]] for i in chunk[offsets[:-1]].tolist()]
            held += self.heads.of(first, self._learn)
        else:
            held = self.kept.of(chunks, self._learn_words)
        ids = pa.array(held, pa.large_binary()).take(pa.array(chunk))
        cuts = np.frombuffer(ids.buffers()[1], np.int64)[offsets].tolist()
        raw = memoryview(ids.buffers()[2] or b"")
        return [raw[start:end].tobytes() for start, end in zip(cuts, cuts[1:])]

    def _by_rule(self, text: bytes) -> bytes:
        """A text with other blanks than single ones, chunk by chunk of the general rule."""
        chunks = [c.encode() for c in _CHUNK.findall(text.decode())]
        distinct = list(dict.fromkeys(chunks))
        return b"".join(map(dict(zip(distinct, self.heads.of(distinct, self._learn))).__getitem__, chunks))

    def encode(self, texts: list[bytes]) -> list[bytes]:
        if self.mark is None:
            return self.encode_plain(texts)
        alone = {i: self.encode_plain([text])[0] for i, text in enumerate(texts) if any(map(text.__contains__, self.held["own"]))}
        if self.blanks:
            alone |= {i: self._by_rule(text) for i, text in enumerate(texts)
                      if i not in alone and any(map(text.__contains__, _LONG_BLANKS))}
        rest = iter(self._blocks([text for i, text in enumerate(texts) if i not in alone]))
        return [alone[i] if i in alone else next(rest) for i in range(len(texts))]

    def _blocks(self, texts: list[bytes]) -> list[bytes]:
        out, block, size = [], [], 0
        for text in texts:
            block.append(text)
            size += len(text)
            if size >= BLOCK_BYTES:
                out += self._block(block)
                block, size = [], 0
        return out + self._block(block) if block else out
