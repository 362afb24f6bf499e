"""Token ids of whole texts from a public vocabulary file, distinct word by distinct word."""

from __future__ import annotations

import json
import os
import string
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

DEFAULT_FILE = "word_bpe_49k.json"
# Distinct words a worker remembers, and bytes of text it works on at a time.
REMEMBERED = 400_000
PIECE_BYTES = 4 << 20
LEARNT = 20_000  # words given to the tokenizer at a time
# Signs that are no part of a word they follow; an apostrophe may be one.
_MARKS = string.punctuation.replace("'", "").encode()
_ALNUM = frozenset(b"abcdefghijklmnopqrstuvwxyz0123456789")


def default_path() -> str:
    import public_tokenizers

    return public_tokenizers.path(DEFAULT_FILE)


class WordEncoder:
    """Encodes texts by their words between ASCII white space, each distinct word once.

    Right for tokenizers that lower-case, drop white space and cut at it and between letters,
    digits and other signs, as the default one does: no token then depends on what stands beyond
    such a cut. The signs behind a word are a word of their own. When the memory of
    words is full, it drops those of a single piece of text, which changes no result.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # Spark runs a task on each core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        suffix = json.loads(self.tokenizer.to_str())["model"].get("end_of_word_suffix")
        self.last = np.zeros(max(self.tokenizer.get_vocab().values()) + 1, bool)
        if suffix:
            self.last[[i for token, i in self.tokenizer.get_vocab().items() if token.endswith(suffix)]] = True
        self.forget()

    def forget(self) -> None:
        self.index: dict[bytes, int] = {b"": 0}
        self.ids = np.empty(1 << 20, np.uint32)
        self.ends = np.zeros(1 << 16, np.int32)
        self.uses = np.zeros(1 << 16, np.int32)

    def forget_rare(self) -> None:
        n = len(self.index)
        keep = np.flatnonzero(self.uses[1:n] > 1) + 1
        if len(keep) > REMEMBERED // 2:
            self.forget()
            return
        words = np.fromiter(self.index, object, n)[keep].tolist()
        ends = self.ends[keep]
        lengths = ends - self.ends[keep - 1]
        total = np.cumsum(lengths)
        size = int(total[-1]) if len(total) else 0
        ids, uses = self.ids[np.repeat(ends - total, lengths) + np.arange(size)], self.uses[keep]
        self.forget()
        self._store(words, ids, lengths)
        self.uses[1 : len(words) + 1] = uses

    def learn(self, words: list[bytes]) -> None:
        texts = pa.array(words, pa.binary()).cast(pa.string())
        # Normal letters only, then a word is one run for the tokenizer and has one last token.
        normal = pc.utf8_lower(pc.utf8_normalize(texts, "NFC"))
        plain = pc.and_(pc.utf8_is_alpha(normal), pc.utf8_is_alpha(texts)).to_numpy(zero_copy_only=False)
        if self.last.any() and plain.any():
            chosen = texts.filter(pa.array(plain))
            found = self.tokenizer.encode_batch_fast([" ".join(chosen.to_pylist())], add_special_tokens=False)
            ids = np.array(found[0].ids, np.uint32)
            ends = np.flatnonzero(self.last[ids]) + 1
            self._store([w for w, own in zip(words, plain.tolist(), strict=True) if own], ids, np.diff(ends, prepend=0))
        else:
            plain[:] = False
        other = [w for w, own in zip(words, plain.tolist(), strict=True) if not own]
        if other:
            found = self.tokenizer.encode_batch_fast([w.decode() for w in other], add_special_tokens=False)
            found = [x.ids for x in found]
            self._store(other, [i for ids in found for i in ids], list(map(len, found)))

    def _store(self, words: list[bytes], ids: list[int], lengths) -> None:
        n, at = len(self.index), int(self.ends[len(self.index) - 1])
        while at + len(ids) > len(self.ids):
            self.ids = np.concatenate([self.ids, np.empty_like(self.ids)])
        while n + len(words) > len(self.ends):
            self.ends = np.concatenate([self.ends, np.empty_like(self.ends)])
            self.uses = np.concatenate([self.uses, np.zeros_like(self.uses)])
        self.ids[at : at + len(ids)] = ids
        self.ends[n : n + len(words)] = at + np.cumsum(lengths)
        self.index.update(zip(words, range(n, n + len(words)), strict=True))

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All ids, and where those of each text end; texts: large binary without nulls."""
        texts = texts.cast(pa.large_string())
        marks = _MARKS
        if pc.any(pc.match_substring(texts, "<|")).as_py():  # special tokens have capitals and signs
            marks = b""
        else:
            texts = pc.ascii_lower(texts)
        split = pc.ascii_split_whitespace(texts)
        found = split.flatten().dictionary_encode()
        places, parts = found.indices.to_numpy(), []
        for word in found.dictionary.cast(pa.large_binary()).to_pylist():
            core = word.rstrip(marks)
            if core is not word and core and core[-1] in _ALNUM:
                parts += (core, word[len(core) :])
            else:
                parts += (word, b"")
        new = list(set(parts).difference(self.index))
        if len(self.index) + len(new) > REMEMBERED and len(self.index) > 1:
            self.forget_rare()
            new = list(set(parts).difference(self.index))
        for i in range(0, len(new), LEARNT):
            self.learn(new[i : i + LEARNT])
        at = np.fromiter(map(self.index.__getitem__, parts), np.int32, len(parts))
        self.uses[at] += 1
        at = at.reshape(-1, 2)[places].ravel()
        ends = self.ends[at]
        lengths = ends - np.where(at > 0, self.ends[at - 1], 0)
        total = np.cumsum(lengths, dtype=np.int32)
        size = int(total[-1]) if len(total) else 0
        ids = self.ids[np.repeat(ends - total, lengths) + np.arange(size, dtype=np.int32)]
        words = split.offsets.to_numpy()[1:] - split.offsets[0].as_py()
        return ids, np.concatenate([[0], total])[2 * words]

    def stream(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text in turn. Long texts are worked on in pieces cut at blanks."""
        texts = texts.cast(pa.large_binary()).fill_null(b"")
        ends = np.cumsum(pc.binary_length(texts).to_numpy())
        i, done = 0, 0
        while i < len(texts):
            j = max(i + 1, int(np.searchsorted(ends, done + PIECE_BYTES, "right")))
            if j == i + 1 and ends[i] - done > PIECE_BYTES:
                parts = (self.encode(pa.array([p], pa.large_binary()))[0] for p in pieces(texts[i].as_py()))
                yield np.concatenate(list(parts))
            else:
                ids, cuts = self.encode(texts[i:j])
                yield from np.split(ids, cuts[:-1])
            i, done = j, int(ends[j - 1])


def pieces(text: bytes) -> Iterator[bytes]:
    at = 0
    while at < len(text):
        cut = text.find(b" ", at + PIECE_BYTES)
        cut = len(text) if cut < 0 else cut
        yield text[at:cut]
        at = cut


_encoders: dict[str, WordEncoder] = {}


def encoder(path: str) -> WordEncoder:
    """One encoder for each worker process, kept from task to task."""
    if path not in _encoders:
        _encoders[path] = WordEncoder(path)
    return _encoders[path]
