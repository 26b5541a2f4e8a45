"""Token ids of whole texts by the ``tokenizers`` library, each distinct word encoded once.

Some tokenizers never join characters across white space: a text's ids are then the
ids of its parts, one after the other, if it is cut in front of white space
(byte-level BPE, which puts a space in front of its word) or at white space (BPE with
word ends, which drops it). Arrow splits a batch of texts into parts and numbers the
distinct ones and looks them up among those its worker has met, kept as Arrow and
NumPy arrays; the library encodes the others, and NumPy puts the ids in place. Words of Latin letters and printable ASCII go to the library's BPE model
straight, split as the tokenizer's own rule splits them; all others, texts with kinds of white
space on which rules may differ, and tokenizers of any other kind go through the whole
tokenizer. Strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import json
import os
import re
import sys
from array import array
from collections.abc import Iterator
from functools import lru_cache
from string import punctuation

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc

#: white space beyond space and the control codes 9 to 13, and other invisible characters
_RARE = "\x1c-\x1f\x85\xa0 ᠎ -‏ -  -⁠　﻿"
RARE = re.compile(f"[{_RARE}]")
#: texts in which a part is more than one blank and the word behind it
UNEVEN = f"[\t\r\x0b\x0c{_RARE}]|[ \n][ \n]|^[ \n]|[ \n]$"
PARTS = re.compile(r"[\x20\x09-\x0D]*[^\x20\x09-\x0D]+|[\x20\x09-\x0D]+")
#: parts kept per worker, and the longest one kept in bytes
KEPT, KEPT_BYTES = 300_000, 64
#: bytes of text split at once
CHUNK = 2 << 20

# the splitting rules of the two kinds of tokenizer, for ASCII
BYTE_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d| ?[A-Za-z]+| ?[0-9]+| ?[^\sA-Za-z0-9]+|\s+(?!\S)|\s+")
END_WORD = re.compile(r"'s|'t|'re|'ve|'m|'ll|'d|[a-z]+|[0-9]|[^\sa-z0-9]+")


#: letters below this one are the same to every Unicode version and stand composed
LATIN = "\u0250"


def _shown() -> dict[int, str]:
    """How byte-level models show each byte: printable Latin-1 as it is, the others from U+0100 on."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    others = (b for b in range(256) if b not in plain)
    return {b: chr(b) for b in plain} | {b: chr(0x100 + n) for n, b in enumerate(others)}


SHOWN = _shown()


def _kind(rules: dict) -> str:
    """"byte": cut in front of white space; "end": cut at white space; "": not at all."""
    before, normal = rules.get("pre_tokenizer") or {}, rules.get("normalizer")
    if before.get("type") == "ByteLevel" and normal is None:
        return "byte" if before.get("use_regex") and not before.get("add_prefix_space") else ""
    steps = [s.get("type") for s in (normal or {}).get("normalizers", [])]
    inner = before.get("pretokenizers") or [{}]
    rule = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"
    split = inner[0].get("type") == "Split" and inner[0].get("pattern") == {"Regex": rule}
    return "end" if split and inner[0].get("invert") and steps == ["NFC", "Replace", "Lowercase"] else ""


class Encoder:
    """Encodes Arrow columns of texts.

    In the working tables a part is named by a key: with kind "end" the word itself;
    with kind "byte" a word stands for itself behind one space, a key that begins with
    a line feed for itself, and one that begins with a space for the rest of it.
    """

    def __init__(self, path: str):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # tasks share a machine already
        from tokenizers import Tokenizer

        if sys.byteorder != "little" or array("I").itemsize != 4:
            raise RuntimeError("ids are kept as this machine's little-endian unsigned 32-bit integers")

        with open(path, encoding="utf-8") as f:
            rules = json.load(f)
        self.kind = _kind(rules)
        #: strings of added tokens; in any case, as a normalizer may fold it before they are looked for
        self.added = "|".join(re.escape(t["content"]) for t in rules.get("added_tokens") or ())
        self.tokenizer = Tokenizer.from_file(path)
        self.model = self.tokenizer.model
        #: the narrowest type that holds every id
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        self.signs: dict[str, bytes] = {}
        # parts met before, their ids one after the other, where each part's begin, how many, and whether met again
        self.known = pa.array([], pa.string())
        self.ids, self.start, self.size = np.empty(0, "<u4"), np.empty(0, np.int64), np.empty(0, np.int64)
        self.again = np.empty(0, bool)

    def _library(self, texts: list[str]) -> list[bytes]:
        found = self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)
        return [array("I", e.ids).tobytes() for e in found]

    def _text(self, key: str) -> str:
        if self.kind == "end" or key[:1] == "\n":
            return key
        return key[1:] if key[:1] == " " else " " + key

    def _encode(self, keys: list[str]) -> dict[str, bytes]:
        """Ids of parts that the worker has not met."""
        model, rest, found = self.model.tokenize, [], {}
        end, blank = self.kind == "end", "" if self.kind == "end" else "Ġ"
        for key in keys:
            word = key.rstrip(punctuation)
            if word.isalpha() and (key.isascii() or max(word) < LATIN):  # a word, and perhaps signs behind it
                shown = word.lower() if end else word
                if not shown.isascii():
                    if not shown.isalpha():  # lower case has added a mark
                        rest.append(key)
                        continue
                    shown = shown.encode().decode("latin-1").translate(SHOWN)
                ids = array("I", [t.id for t in model(blank + shown)]).tobytes()
                found[key] = ids + self._signs(key[len(word) :]) if len(word) < len(key) else ids
            elif not (key.isascii() and key.strip("\n ").isprintable()):
                rest.append(key)
            else:
                words = END_WORD.findall(key.lower()) if end else BYTE_WORD.findall(self._text(key))
                if not end:
                    words = [w.replace(" ", "Ġ").replace("\n", "Ċ") for w in words]
                found[key] = array("I", [t.id for w in words for t in model(w)]).tobytes()
        if rest:
            found.update(zip(rest, self._library([self._text(k) for k in rest]), strict=True))
        return found

    def _signs(self, signs: str) -> bytes:
        ids = self.signs.get(signs)
        if ids is None:
            ids = array("I", [t.id for t in self.model.tokenize(signs)]).tobytes()
            if len(self.signs) < 1 << 12:
                self.signs[signs] = ids
        return ids

    def _look_up(self, keys: pa.Array) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Ids of distinct keys: all of them, where each key's begin and how many."""
        at = pc.index_in(keys, value_set=self.known)
        missing = at.is_null()
        at = at.fill_null(-1).to_numpy(zero_copy_only=False).astype(np.int64)
        new = keys.filter(missing)
        words = new.to_pylist()
        found = self._encode(words)
        found = [found[w] for w in words]
        ids = np.concatenate([self.ids, np.frombuffer(b"".join(found), "<u4")])
        size = np.concatenate([self.size, np.fromiter(map(len, found), np.int64, len(found)) // 4])
        start = np.concatenate([self.start, len(self.ids) + np.cumsum(size[len(self.size) :]) - size[len(self.size) :]])
        at[at < 0] = np.arange(len(self.size), len(size))
        self.again[at[at < len(self.again)]] = True
        self._keep(new, ids, start, size, at)
        return ids, start[at], size[at]

    def _keep(self, new: pa.Array, ids: np.ndarray, start: np.ndarray, size: np.ndarray, at: np.ndarray) -> None:
        """Keep what was looked up; past ``KEPT`` parts, those met more than once and the latest."""
        known = pa.concat_arrays([self.known, new])
        keep = pc.binary_length(known).to_numpy(zero_copy_only=False) <= KEPT_BYTES
        again = np.concatenate([self.again, np.zeros(len(new), bool)])
        if keep.all() and len(known) <= KEPT:
            self.known, self.ids, self.start, self.size, self.again = known, ids, start, size, again
            return
        if len(known) > KEPT:
            latest = np.zeros(len(known), bool)
            latest[at] = True
            keep &= latest | again if (latest | again).sum() <= KEPT else latest
            again = np.zeros(len(known), bool)
        self.known, self.again, start, self.size = known.filter(pa.array(keep)), again[keep], start[keep], size[keep]
        self.start = np.cumsum(self.size) - self.size
        self.ids = ids[np.repeat(start - self.start, self.size) + np.arange(self.size.sum())]

    def _put(self, parts: pa.Array, ends: np.ndarray, first: bool) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number per text, given all texts' keys; ``first``: nothing stands in front of a text's first."""
        numbered = parts.dictionary_encode()
        keys, at = numbered.dictionary, numbered.indices.to_numpy(zero_copy_only=False)
        if first and len(ends) > 1:
            marked = pc.binary_join_element_wise(pa.scalar(""), parts.take(pa.array(ends[:-1])), " ")
            marked = marked.dictionary_encode()  # a key that begins with a space is no part's
            at = at.copy()
            at[ends[:-1]] = len(keys) + marked.indices.to_numpy(zero_copy_only=False)
            keys = pa.concat_arrays([keys, marked.dictionary])
        ids, start, size = self._look_up(keys)
        length = size[at]
        place = np.concatenate([[0], np.cumsum(length)])
        ids = ids[np.repeat(start[at] - place[:-1], length) + np.arange(place[-1])]
        return ids, np.diff(place[ends])

    def _even(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """Ids and their number per text, for texts that Arrow can cut."""
        if self.kind == "end":
            cut = pc.ascii_split_whitespace(texts)
        else:
            cut = pc.split_pattern(pc.replace_substring(texts, "\n", " \n"), " ")
        return self._put(cut.flatten(), cut.offsets.to_numpy() - cut.offsets[0].as_py(), self.kind == "byte")

    def _uneven(self, texts: list[str]) -> Iterator[np.ndarray]:
        """Ids of texts that Python has to cut."""
        added = re.compile(self.added, re.IGNORECASE) if self.added else None
        whole = [self.kind != "byte" or RARE.search(t) is not None or (added and added.search(t)) for t in texts]
        cut = [[] if w else [" " + p for p in PARTS.findall(t)] for t, w in zip(texts, whole)]
        ends = np.concatenate([[0], np.cumsum([len(c) for c in cut])]).astype(np.int64)
        ids, sizes = self._put(pa.array([p for c in cut for p in c], pa.string()), ends, False)
        place = np.concatenate([[0], np.cumsum(sizes)])
        for i, (text, alone) in enumerate(zip(texts, whole)):
            yield np.frombuffer(self._library([text])[0], "<u4") if alone else ids[place[i] : place[i + 1]]

    def _chunk(self, texts: pa.Array) -> Iterator[np.ndarray]:
        if self.kind == "end":
            apart = np.zeros(len(texts), bool)
        elif self.kind == "byte":
            apart = pc.match_substring_regex(texts, UNEVEN).to_numpy(zero_copy_only=False)
        else:
            apart = np.ones(len(texts), bool)
        if self.added:
            apart = apart | pc.match_substring_regex(texts, self.added, ignore_case=True).to_numpy(zero_copy_only=False)
        ids, sizes = self._even(texts.filter(pa.array(~apart))) if not apart.all() else (None, np.empty(0, np.int64))
        uneven = self._uneven(texts.filter(pa.array(apart)).to_pylist()) if apart.any() else iter(())
        ends = iter(np.cumsum(sizes).tolist())
        at = 0
        for alone in apart.tolist():
            if alone:
                yield next(uneven)
            else:
                end = next(ends)
                yield ids[at:end]
                at = end

    def __call__(self, texts: pa.Array) -> Iterator[np.ndarray]:
        """The ids of each text; null counts as empty."""
        texts = pc.fill_null(texts.cast(pa.string()), "")
        sizes = pc.binary_length(texts).to_numpy(zero_copy_only=False)
        begin = size = 0
        for i, n in enumerate(sizes.tolist()):
            if size and size + n > CHUNK:
                yield from self._chunk(texts.slice(begin, i - begin))
                begin, size = i, 0
            size += n
        if begin < len(texts):
            yield from self._chunk(texts.slice(begin))
        pa.default_memory_pool().release_unused()  # workers stay when a task ends


@lru_cache(maxsize=4)
def encoder(path: str) -> Encoder:
    """One encoder per worker process and tokenizer file."""
    return Encoder(path)
