"""Exact token ids with a bounded cache of words.

The ids of a text are those of the ``tokenizers`` library.  Most of the
library's time goes into words it has met before, so texts are cut where
their pre-tokenizer always cuts (before white space that follows another
character), the chunks of many texts are made distinct by Arrow's dictionary
encoding, and only chunks not met lately are handed to the library: plain
words to its model, others many at once to the tokenizer, joined by a special
token that never merges with its neighbours.

Two cuts are known.  ``"word"``: the pre-tokenizer drops white space, chunks
are the words.  ``"space"``: white space belongs to the chunk it precedes.
Texts in which the fast cut could differ from the library's own are cut by
the exact white-space class or passed whole.
"""

from __future__ import annotations

import os
import re
import sys
from array import array

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: Unicode white space, as the tokenizers' patterns know it (fixed values).
_WS = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"
_CHUNK = re.compile(f"[{_WS}]*[^{_WS}]+|[{_WS}]+")
_WORD = re.compile(f"[^{_WS}]+")
#: Texts that the fast cuts do not suit, as Arrow's patterns say it.
_SPACED_RE = f"[{_WS}\x1c-\x1f][ \n]"
_ODD_RE = "[\x1c-\x1f]"
#: Below it letters are whole in NFC and have one small letter each (fixed value).
_PLAIN_BELOW = "\u0130"
#: Words that are not put in small letters (those of a special token would become the token).
_HIGH_RE = f"[{_PLAIN_BELOW}-\U0010ffff]|<[|]"
_MARKED_RE = r"\pL[.,]$"
#: Byte-level vocabularies write bytes that do not print as the characters from U+0100 on.
_BYTES = {b: 256 + i for i, b in enumerate([*range(33), *range(127, 161), 173])}


def _text(value: str | None) -> pa.Scalar:
    return pa.scalar(value, pa.large_string())


class Encoder:
    """``encode(texts)`` gives each text's ids as little-endian unsigned 32-bit bytes."""

    def __init__(self, path: str, cut: str, cache_words: int = 200_000):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        from tokenizers import Tokenizer

        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("ids are written as little-endian 32-bit integers")
        self.lib = Tokenizer.from_file(path)
        self.model = self.lib.model
        self.mark = "<|endoftext|>"
        self.mark_id = self.lib.token_to_id(self.mark)
        self.cut, self.size = cut, cache_words
        self.new: dict[str, bytes] = {}
        self.old: dict[str, bytes] = {}

    def _chunk(self, key: str) -> str:
        """The text that a key of the cache stands for.

        In ``"space"`` cuts a word after a space is its own key, without the
        space; a line's first word has the line break in front; a text's
        first word a line break and a space, and other chunks one space more.
        """
        if self.cut == "word":
            return key
        if key[:1] != "\n":
            return " " + key
        return key if key[1:2] != " " else key[2:] if key[2:3] != " " else key[3:]

    def _parts(self, keys: pa.Array) -> tuple[pa.Array, pa.Array]:
        """For each key two keys whose ids, one after the other, are the key's; the second may be null.

        Letters and a closing mark are never one token, and a vocabulary of
        words knows no capitals.
        """
        if self.cut == "word":
            keys = pc.if_else(pc.match_substring_regex(keys, _HIGH_RE), keys, pc.utf8_lower(keys))
        marked = pc.match_substring_regex(keys, _MARKED_RE)
        marks = pc.utf8_slice_codeunits(keys, -1)
        if self.cut != "word":
            marks = pc.binary_join_element_wise(_text("\n "), marks, _text(""))
        return pc.if_else(marked, pc.utf8_slice_codeunits(keys, 0, -1), keys), pc.if_else(marked, marks, _text(None))

    def _plain(self, texts: list[str]) -> list[bytes]:
        return [np.array(e.ids, dtype="<u4").tobytes() for e in self.lib.encode_batch_fast(texts, add_special_tokens=False)]

    def _learn(self, keys: list[str]) -> None:
        """Ids of chunks not met lately.

        Latin letters (in ``"space"`` cuts after one space or none) are one
        pre-token, which the library's model takes by its bytes; all others go
        through the whole tokenizer, joined by the special token.
        """
        tokenize, rest = self.model.tokenize, []
        for key in keys:
            c = self._chunk(key)
            word = c[1:] if c[0] == " " else c
            if word.isalpha() and (c.isascii() or max(c) < _PLAIN_BELOW):
                if not c.isascii():
                    word = word.encode().decode("latin-1").translate(_BYTES)
                self.new[key] = array("I", [t.id for t in tokenize("\u0120" + word if c[0] == " " else word)]).tobytes()
            elif self.mark in c:
                self.new[key] = self._plain([c])[0]
            else:
                rest.append((key, c))
        if not rest:
            return
        ids = np.array(self.lib.encode_batch_fast([self.mark.join([c for _, c in rest])], add_special_tokens=False)[0].ids, dtype="<u4")
        at = (4 * np.flatnonzero(ids == self.mark_id)).tolist()
        raw = ids.tobytes()
        if len(at) != len(rest) - 1:
            raise RuntimeError("the tokenizer did not keep the separators")
        self.new.update((k, raw[i:j]) for (k, _), i, j in zip(rest, [0, *[x + 4 for x in at]], [*at, len(raw)]))

    def _cut(self, texts: pa.Array) -> tuple[np.ndarray, pa.Array]:
        """(place of each text's first key, all keys) of texts that the fast cut suits."""
        if self.cut == "word":
            lists = pc.utf8_split_whitespace(texts)
        else:
            lists = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        keys = lists.values
        if self.cut == "word":
            keys = pc.if_else(pc.equal(keys, _text("")), _text(None), keys)
        return lists.offsets.to_numpy(), keys

    def _known(self, keys: pa.Array) -> pa.Array:
        """The ids of each key, none for a null one."""
        base, mark = self._parts(keys)
        coded = pa.chunked_array([base, mark]).combine_chunks().dictionary_encode()
        named = coded.dictionary.to_numpy(zero_copy_only=False).tolist()
        if len(self.new) > self.size:
            self.old, self.new = self.new, {}
        new, old = self.new, self.old
        ids = list(map(new.get, named))
        lacking = [k for k, x in enumerate(ids) if x is None]
        unknown = []
        for k in lacking:
            if (x := old.get(named[k])) is not None:
                new[named[k]] = x
            else:
                unknown.append(named[k])
        if unknown:
            self._learn(unknown)
        for k in lacking:
            ids[k] = new[named[k]]
        table, codes = pa.array(ids, pa.large_binary()), coded.indices
        first, second = table.take(codes[: len(keys)]), table.take(codes[len(keys) :])
        return pc.binary_join_element_wise(first, second, pa.scalar(b"", pa.large_binary()), null_handling="replace")

    def _looked_up(self, at: np.ndarray, keys: pa.Array, opened: bool) -> list[bytes]:
        """Each text's ids; ``at`` has the place of its first key, and the end.

        Every different key is looked up once.  ``opened``: a text's first key
        lacks its mark, and stands for nothing if empty.
        """
        coded = keys.dictionary_encode()
        codes, named = coded.indices, coded.dictionary
        if opened:
            opening = keys.take(pa.array(at[:-1])).dictionary_encode()
            own = codes.to_numpy().copy()
            own[at[:-1]] = len(named) + opening.indices.to_numpy()
            codes = pa.array(own)
            first = opening.dictionary
            first = pc.if_else(pc.equal(first, _text("")), _text(None), pc.binary_join_element_wise(_text("\n "), first, _text("")))
            named = pa.chunked_array([named, first]).combine_chunks()
        held = self._known(named).take(codes)
        _, offsets, data = held.buffers()
        ends = np.frombuffer(offsets, "<i8", len(held) + 1, 8 * held.offset)[at].tolist() if len(held) else [0] * len(at)
        return [data[i:j].to_pybytes() if i < j else b"" for i, j in zip(ends, ends[1:])]

    def encode(self, texts: list[str]) -> list[bytes]:
        """Each text's ids."""
        held = pa.array(texts, pa.large_string())
        odd = pc.match_substring_regex(held, _ODD_RE if self.cut == "word" else _SPACED_RE).to_numpy(zero_copy_only=False)
        out: list[bytes] = [b""] * len(texts)
        plain = np.flatnonzero(~odd)
        if len(plain):
            at, keys = self._cut(held if len(plain) == len(texts) else held.take(pa.array(plain)))
            for k, ids in zip(plain.tolist(), self._looked_up(at, keys, self.cut == "space")):
                out[k] = ids
        if len(plain) < len(texts):
            rest = np.flatnonzero(odd).tolist()
            cut = [_WORD.findall(texts[k]) if self.cut == "word" else ["\n  " + c for c in _CHUNK.findall(texts[k])] for k in rest]
            at = np.append(0, np.cumsum([len(c) for c in cut]))
            for k, ids in zip(rest, self._looked_up(at, pa.array([c for chunks in cut for c in chunks], pa.large_string()), False)):
                out[k] = ids
        return out


_ENCODERS: dict[tuple[str, str], Encoder] = {}


def encoder(path: str, cut: str) -> Encoder:
    """One encoder for each Python worker and vocabulary."""
    if (path, cut) not in _ENCODERS:
        _ENCODERS[path, cut] = Encoder(path, cut)
    return _ENCODERS[path, cut]


def groups(texts: list[str], chars: int = 2_000_000):
    """Ranges of ``texts`` with about ``chars`` characters each, a longer text alone."""
    start, n = 0, 0
    for i, t in enumerate(texts):
        if n and n + len(t) > chars:
            yield start, i
            start, n = i, 0
        n += len(t)
    if start < len(texts):
        yield start, len(texts)
