"""Token ids by the tokenizers library, each distinct piece of text encoded once.

A byte-level tokenizer starts a new pre-token at every space that a visible
character follows, and a tokenizer that drops white space starts one after it; both
start one after a word. So texts are cut there, Arrow numbers the pieces, only pieces
not met before are encoded, and the ids of all occurrences are gathered by number;
they are those of the whole text. Texts that hold an added token's string, and texts
of other tokenizers, are encoded whole.
"""

from __future__ import annotations

import json
import os
import re
from collections.abc import Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Pieces a worker keeps before it starts anew: bounds its memory.
KEPT_PIECES = 1_000_000
#: Bytes of text whose pieces are numbered together (one text may be longer).
BATCH_BYTES = 16_000_000

_CUT = re.compile(r"(?= \S)")
_ODD = r" (?:[\s\x0b\x1c-\x1f\x{85}\p{Z}]|$)|\x01"
_SEPARATORS = r"[\x1c-\x1f]"
#: A word's last letter and what starts a new pre-token behind it. Letters that lower
#: case or composition may end in a mark are left out.
_WORD_END = r"([A-Za-z\x{C0}-\x{D6}\x{D8}-\x{F6}\x{F8}-\x{12F}\x{131}-\x{24F}])([\n!-@\[-`{-~])"
_ENCODERS: dict[tuple, "PieceEncoder"] = {}


def encoder(path: str, dtype: str = "<u4", special_as_text: bool = False) -> "PieceEncoder":
    """One encoder per worker process, tokenizer file, width of an id and treatment of added tokens."""
    key = (path, dtype, special_as_text)
    if key not in _ENCODERS:
        _ENCODERS[key] = PieceEncoder(path, dtype, special_as_text=special_as_text)
    return _ENCODERS[key]


class PieceEncoder:
    """``special_as_text``: the strings of special tokens in a text are ordinary text;
    by default they get their own ids, as the library's defaults have it."""

    def __init__(self, path: str, dtype: str = "<u4", kept: int = KEPT_PIECES, special_as_text: bool = False):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        with open(path, encoding="utf-8") as file:
            spec = json.load(file)
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = special_as_text
        self.added = [t["content"] for t in spec.get("added_tokens") or [] if not (special_as_text and t.get("special"))]
        self.dtype, self.kept = np.dtype(dtype), kept
        self._forget()
        self.form, (self._sizes, self._last) = _form(spec), self._token_shapes(spec)
        if self.tokenizer.get_vocab_size(with_added_tokens=True) - 1 > np.iinfo(self.dtype).max:
            raise ValueError(f"ids of {path} do not fit {dtype}")

    def _forget(self) -> None:
        """``known`` are pieces, ``ids`` what they stand for; ``seen`` has the rare ones."""
        self.known, self.ids, self.seen = pa.array([], pa.string()), pa.array([], pa.large_binary()), {}

    def encode(self, texts: Sequence[str] | pa.Array) -> list[bytes]:
        """The ids of each text as bytes of ``dtype``."""
        texts = texts if isinstance(texts, pa.Array) else pa.array(texts, pa.string())
        ends = np.cumsum(pc.binary_length(texts).to_numpy(zero_copy_only=False).astype(np.int64))
        out, start = [], 0
        while start < len(texts):
            reached = ends[start - 1] if start else 0
            stop = max(start + 1, int(np.searchsorted(ends, reached + BATCH_BYTES, "right")))
            out += self._encode_batch(texts.slice(start, stop - start))
            start = stop
        return out

    def _encode_batch(self, texts: pa.Array) -> list[bytes]:
        if len(self.known) + len(self.seen) > self.kept:
            self._forget()
        whole = np.full(len(texts), self.form == "whole")
        for token in self.added:
            whole |= pc.match_substring(texts, token, ignore_case=True).to_numpy(zero_copy_only=False)
        odd = pc.match_substring_regex(texts, _ODD if self.form == "spaced" else _SEPARATORS).to_numpy(zero_copy_only=False)
        usual = np.flatnonzero(~whole & ~odd)
        out: list[bytes] = [b""] * len(texts)
        for i, ids in zip(usual.tolist(), self._usual(texts.take(pa.array(usual)))):
            out[i] = ids
        for i in np.flatnonzero(~whole & odd).tolist():
            text = texts[i].as_py()
            out[i] = b"".join(self._rare(_CUT.split(text) if self.form == "spaced" else [text]))
        at = np.flatnonzero(whole).tolist()
        found = self.tokenizer.encode_batch_fast([texts[i].as_py() for i in at], add_special_tokens=False)
        for i, e in zip(at, found):
            out[i] = np.array(e.ids, self.dtype).tobytes()
        return out

    def _usual(self, texts: pa.Array) -> list[bytes]:
        """Texts whose pieces stand between single spaces (or are words): Python sees a
        distinct piece once, Arrow copies the ids of its occurrences."""
        if not len(texts):
            return []
        if self.form == "spaced":
            marked = pc.replace_substring_regex(texts, _WORD_END, "\\1\x01\\2")
            lists = pc.split_pattern(pc.replace_substring(marked, " ", "\x01 "), "\x01")
        else:
            lists = pc.utf8_split_whitespace(pc.replace_substring_regex(texts, _WORD_END, r"\1 \2"))
        bounds = lists.offsets.to_numpy().astype(np.int64)
        bounds -= bounds[0]
        at = self._numbers(lists.flatten())
        ids = self.ids.take(pa.array(at))
        ends = np.frombuffer(ids.buffers()[1], np.int64)[ids.offset:ids.offset + len(ids) + 1]
        flat, cuts = memoryview(ids.buffers()[2] or b""), ends[bounds].tolist()
        return [bytes(flat[a:b]) for a, b in zip(cuts, cuts[1:])]

    def _numbers(self, pieces: pa.Array) -> np.ndarray:
        """Place of each piece among the known ones; new ones are encoded and join them."""
        at = pc.index_in(pieces, value_set=self.known)
        new = at.is_null()
        at = at.fill_null(0).to_numpy().astype(np.int64)
        if missing := pc.sum(new).as_py():
            fresh = pieces.filter(new)
            distinct, base = fresh.unique(), len(self.known)
            self.ids = pa.concat_arrays([self.ids, *(self._encode_pieces(distinct.slice(i, 5_000))
                                                     for i in range(0, len(distinct), 5_000))])
            self.known = pa.concat_arrays([self.known, distinct])
            place = pc.index_in(fresh, value_set=distinct).to_numpy()
            at[new.to_numpy(zero_copy_only=False)] = place[:missing] + base
        return at

    def _rare(self, pieces: list[str]) -> list[bytes]:
        fresh = list(set(pieces) - self.seen.keys())
        for p, e in zip(fresh, self.tokenizer.encode_batch_fast(fresh, add_special_tokens=False)):
            self.seen[p] = np.array(e.ids, self.dtype).tobytes()
        return [self.seen[p] for p in pieces]

    def _encode_pieces(self, pieces: pa.Array) -> pa.Array:
        """Encode plain words as one text and cut its ids where each word ends; other
        pieces one by one."""
        names = pieces.to_numpy(zero_copy_only=False).tolist()
        found: list[bytes | None] = [None] * len(names)
        if self.form == "spaced":
            words = [i for i, p in enumerate(names) if len(p) > 1 and p[0] == " " and p[1:].isalpha()]
            joined = "".join([names[i] for i in words])
        else:
            words = [i for i, p in enumerate(names) if p.isalpha()]
            joined = " ".join([names[i] for i in words])
        ids = np.array(self.tokenizer.encode_batch_fast([joined], add_special_tokens=False)[0].ids, np.int64)
        if self.form == "spaced":
            ends = np.cumsum(np.array([len(names[i].encode()) for i in words], np.int64))
            reached = np.cumsum(self._sizes[ids])
            stops = np.searchsorted(reached, ends) + 1
            sure = len(ids) and reached[-1] == ends[-1] and np.array_equal(reached[np.minimum(stops, len(ids)) - 1], ends)
        else:
            stops = np.flatnonzero(self._last[ids]) + 1
            sure = len(stops) == len(words) and len(ids) and stops[-1] == len(ids)
        if sure:
            flat, width, start = ids.astype(self.dtype).tobytes(), self.dtype.itemsize, 0
            for i, stop in zip(words, (stops * width).tolist()):
                found[i] = flat[start:stop]
                start = stop
        rest = [i for i, ids in enumerate(found) if ids is None]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast([names[i] for i in rest], add_special_tokens=False)):
            found[i] = np.array(e.ids, self.dtype).tobytes()
        return pa.array(found, pa.large_binary())

    def _token_shapes(self, spec: dict) -> tuple[np.ndarray, np.ndarray]:
        """Bytes of text each id stands for (a byte-level token has one character a
        byte), and whether it ends a word."""
        ending = spec.get("model", {}).get("end_of_word_suffix") or ""
        vocab = self.tokenizer.get_vocab(with_added_tokens=True)
        sizes = np.zeros(max(vocab.values(), default=0) + 1, np.int64)
        last = np.zeros(len(sizes), bool)
        for token, i in vocab.items():
            sizes[i] = len(token.removesuffix(ending)) if ending else len(token)
            last[i] = bool(ending) and token.endswith(ending)
        return sizes, last


def _form(spec: dict) -> str:
    before, normal = spec.get("pre_tokenizer") or {}, spec.get("normalizer")
    if before.get("type") == "ByteLevel" and before.get("use_regex", True) and not normal:
        return "whole" if before.get("add_prefix_space") else "spaced"
    steps = before.get("pretokenizers") or [{}]
    kinds = {x.get("type") for x in (normal or {}).get("normalizers", [])}
    if steps[0].get("type") == "Split" and steps[0].get("behavior") == "Removed" and steps[0].get("invert") \
            and kinds <= {"NFC", "Replace", "Lowercase"} and spec.get("model", {}).get("end_of_word_suffix"):
        return "words"
    return "whole"
