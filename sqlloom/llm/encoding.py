"""Token ids of whole texts by a public tokenizer, fast on repeated words.

The library spends about ten microseconds on every word.  Both supported layouts cut a text before
a blank or line feed that follows another character, whatever comes next, so a text is split there
and each worker remembers the ids of the pieces it has seen, at most two generations of ``memo``.  A new piece
is cut by the layout's own pattern and given to the tokenizer's model.  Texts and pieces
outside the cases for which this is exact (other white space, runs of blanks, control
characters, letters beyond U+024F) go through the tokenizer as they are, and so does every
text of a tokenizer with another layout.  A text that holds the string of an added token, ``<|endoftext|>``
for example, goes through the tokenizer too, which makes one id of it.
"""

from __future__ import annotations

import itertools
import json
import os
import re

import numpy as np
import regex

from sqlloom.llm.common import task_cache

MEMO = 400_000
ODD = re.compile(r"[^\S \n]|[\x00-\x09\x0b-\x1f\x7f-\xa0]")
# The patterns of the two layouts.
BYTE_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
WORD_PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def byte_letters() -> str:
    """The character that byte-level vocabularies write for each byte, by byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    others = iter(range(256, 512))
    return "".join(chr(b if b in plain else next(others)) for b in range(256))


class Encoder:
    """Texts to ids, as little-endian numbers of ``dtype``."""

    def __init__(self, path: str, memo: int = MEMO):
        self.memo = memo
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # one task, one core
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.dtype = np.dtype("<u2" if self.tokenizer.get_vocab_size() <= 1 << 16 else "<u4")
        with open(path, encoding="utf-8") as f:
            layout = json.load(f)
        # Strings that the tokenizer looks for before anything else, in whatever case they may match.
        self.added = [t["content"].lower() for t in layout.get("added_tokens", [])]
        # What all of them begin with, letters aside: most texts hold no such mark.
        self.mark = "".join(itertools.takewhile(lambda c: not c.isalpha(), os.path.commonprefix(self.added)))
        before, normal, model = layout["pre_tokenizer"] or {}, layout["normalizer"], layout["model"]
        steps = before.get("pretokenizers", [])
        self.layout = None
        if model["type"] == "BPE" and not model.get("dropout"):
            if before.get("type") == "ByteLevel" and before["use_regex"] and not before["add_prefix_space"] and normal is None:
                self.layout, pattern = "byte", BYTE_PATTERN
            elif (
                [s["type"] for s in steps] == ["Split", "ByteLevel"]
                and steps[0]["pattern"] == {"Regex": WORD_PATTERN}
                and normal
                and [n["type"] for n in normal.get("normalizers", [])] == ["NFC", "Replace", "Lowercase"]
            ):
                self.layout, pattern = "word", WORD_PATTERN
        if self.layout:
            self.cut = regex.compile(pattern).findall
            letters = byte_letters()
            self.letters, self.blank = str.maketrans(dict(enumerate(letters))), letters[32]
        # What was seen lately, and the generation before it, out of which what is still used comes back.  Pieces
        # and the parts that the pattern cuts them into share one memory: most parts are pieces elsewhere.
        self.pieces: dict[str, bytes] = {}
        self.old_pieces = self.pieces

    def plain(self, text: str) -> bytes:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, self.dtype).tobytes()

    def _part(self, part: str) -> bytes:
        if self.layout == "word":
            key = part
        else:
            # In the byte layout a piece's key leaves its blank out; a part without a blank is marked.
            key = part[1:] if part[0] == " " else "\0" + part
        known = self.pieces.get(key)
        if known is None:
            known = self.old_pieces.get(key)
            if known is None:
                if part.isascii() and part.isprintable():
                    written = part.replace(" ", self.blank)
                else:
                    written = part.encode().decode("latin-1").translate(self.letters)
                known = np.array([t.id for t in self.tokenizer.model.tokenize(written)], self.dtype).tobytes()
            self.pieces[key] = known
        return known

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii() and max(piece) > "ɏ":
            return self.plain(piece)
        if self.layout == "word":
            if ODD.search(piece):
                return self.plain(piece)
            piece = piece.lower() if piece.isascii() else self.tokenizer.normalizer.normalize_str(piece)
        return b"".join([self._part(p) for p in self.cut(piece)])

    def _holds_added(self, text: str) -> bool:
        return self.mark in text and any(t in text.lower() for t in self.added)

    def _split(self, text: str) -> list[str] | None:
        """Pieces whose ids, one after the other, are those of the text; None if it can't be cut so."""
        if self.layout == "word":
            return text.replace("\n", " ").split(" ")
        if ODD.search(text):
            return None
        # A piece keeps the blank or line feed before it.
        pieces = text.replace("\n", " \n").split(" ")
        return None if "" in pieces or "\n" in pieces else pieces

    def __call__(self, text: str) -> bytes:
        if not text:
            return b""
        pieces = self._split(text) if self.layout and not self._holds_added(text) else None
        if pieces is None:
            return self.plain(text)
        if self.layout == "byte":
            first, pieces = pieces[0], pieces[1:]
            head = self._piece(first)
        else:
            head = b""
        found = [*map(self.pieces.get, pieces)]
        if None in found:
            if len(self.pieces) + len(pieces) > self.memo:
                self.old_pieces, self.pieces = self.pieces, {}
            known, before = self.pieces, self.old_pieces
            for n, ids in enumerate(found):
                if ids is None:
                    p = pieces[n]
                    ids = known.get(p)
                    if ids is None:
                        ids = before.get(p)
                        if ids is None:
                            # In the byte layout a piece without a line feed had a blank before it.
                            whole = p if self.layout == "word" or p[:1] == "\n" else " " + p
                            ids = self._piece(whole) if p else b""
                        known[p] = ids
                    found[n] = ids
        return head + b"".join(found)


def encoder(path: str, memo: int = MEMO) -> Encoder:
    """The worker's encoder for this tokenizer file, with what it has seen so far."""
    held = task_cache()
    if (path, memo) not in held:
        held[path, memo] = Encoder(path, memo)
    return held[path, memo]
