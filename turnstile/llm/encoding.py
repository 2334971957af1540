"""Token ids of whole texts by the tokenizers library, with the ids of repeated pieces kept for reuse.

The library's splitting step is a regular expression without memory: from a place where one of its
words begins, it goes on as if the text began there.  So a text cut at such places has the ids of
its pieces, in order.  Two kinds of tokenizer files are known, and cut at places that are certain:

``byte``  byte-level BPE: before a space, and around a line end, that has no white space next to it
``word``  BPE with word ends that drops white space: at ASCII white space
both      between an ASCII letter and ASCII punctuation other than the apostrophe

Texts with other white space in them, and other kinds of files, are encoded whole.  Pieces are found
and hashed (128 bits) with numpy; a table of ``SLOTS`` entries has the ids of pieces seen before, a
later piece taking a slot over.  Strings of special tokens in a text are ordinary text.
"""

from __future__ import annotations

import functools
import os
import re

import numpy as np
import pyarrow as pa

from turnstile.llm.rows import joined, span_hashes

SLOT_BITS = 20
#: Ids that the table holds before it starts anew: with the slots, bounds a task's memory.
HEAP_IDS = 8 << 20

#: White space beyond ASCII's six, by any reckoning.
_ODD = re.compile("[\x1c-\x1f\x85\xa0  -​    　﻿]")
_WHITE = np.zeros(256, bool)
_WHITE[[32, *range(9, 14)]] = True
_LETTER = np.zeros(256, bool)
_LETTER[65:91] = _LETTER[97:123] = True
_PUNCT = np.zeros(256, bool)
_PUNCT[[b for b in range(33, 127) if not chr(b).isalnum() and b != 39]] = True
#: Letters of ASCII and Latin-1 in UTF-8, all of them in composed form.
_LETTERS = rb"(?:[A-Za-z]|\xc3[\x80-\x96\x98-\xb6\xb8-\xbf])+"
_SIMPLE = {"byte": re.compile(rb" ?" + _LETTERS), "word": re.compile(_LETTERS)}
#: Byte-level spelling: printable bytes stand for themselves, the others for characters from 256 on.
_OWN = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or b >= 174]
_SPELLING = {b: 256 + k for k, b in enumerate(b for b in range(256) if b not in _OWN)}


class Encoder:
    def __init__(self, path: str):
        # one thread: Spark runs as many tasks as there are cores
        os.environ["TOKENIZERS_PARALLELISM"] = "false"
        os.environ.setdefault("RAYON_NUM_THREADS", "1")
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        steps, names = str(self.tokenizer.pre_tokenizer), str(self.tokenizer.normalizer)
        self.kind = "whole"
        if self.tokenizer.get_added_tokens_decoder() and any(not t.special for t in self.tokenizer.get_added_tokens_decoder().values()):
            pass  # such tokens are found before the text is split
        elif steps.startswith("ByteLevel(add_prefix_space=False") and "use_regex=True" in steps and names == "None":
            self.kind = "byte"
        elif r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+" in steps and r'Replace(pattern=Regex("\s+"), content=" ")' in names:
            self.kind = "word"
        self.type = np.dtype(np.uint16 if self.tokenizer.get_vocab_size() <= 1 << 16 else np.uint32)
        n = 1 << SLOT_BITS
        self.keys = np.zeros((2, n), np.uint64)
        self.at, self.size = np.zeros(n, np.int64), np.full(n, -1, np.int64)
        self.heap = np.zeros(HEAP_IDS, self.type)
        self.used = 0

    def whole(self, texts: list[str]) -> list[np.ndarray]:
        return [np.array(e.ids, self.type) for e in self.tokenizer.encode_batch_fast(texts, add_special_tokens=False)]

    def _fresh(self, pieces: list[bytes]) -> list[list[int]]:
        """Ids of distinct pieces.  One of Latin letters alone is one word to the splitting step and goes to
        the library's model directly, spelt as its byte-level step would spell it."""
        tokenize = self.tokenizer.model.tokenize
        simple, made, rest = _SIMPLE[self.kind].fullmatch, [], []
        for piece in pieces:
            if simple(piece):
                if self.kind == "word":
                    piece = piece.decode().lower().encode()
                made.append([t.id for t in tokenize(piece.decode("latin-1").translate(_SPELLING))])
            else:
                rest.append(len(made))
                made.append(None)
        others = [pieces[i].decode() for i in rest]
        for i, e in zip(rest, self.tokenizer.encode_batch_fast(others, add_special_tokens=False), strict=True):
            made[i] = e.ids
        return made

    def _pieces(self, data: np.ndarray, text_at: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Begins and ends of the pieces of all texts; no piece crosses two texts."""
        white = _WHITE[data]
        cut = np.zeros(len(data) + 1, bool)
        cut[1:-1] = _LETTER[data[:-1]] & _PUNCT[data[1:]]
        cut[text_at] = True
        if self.kind == "word":
            inside = ~white
            start = inside.copy()
            start[1:] &= cut[1:-1] | white[:-1]
            stop = inside.copy()
            stop[:-1] &= cut[1:-1] | white[1:]
            return np.flatnonzero(start), np.flatnonzero(stop) + 1
        cut[text_at[1:] - 1] = True  # the byte put after each text is no part of it
        alone = np.zeros(len(data), bool)
        alone[1:-1] = white[1:-1] & ~white[:-2] & ~white[2:]
        alone[text_at[1:] - 1] = False
        alone[text_at[:-1]] = False
        cut[:-1] |= alone & ((data == 32) | (data == 10))
        cut[1:] |= alone & (data == 10)
        begin = np.flatnonzero(cut[:-1])
        end = np.append(begin[1:], len(data))
        own = np.ones(len(begin), bool)
        own[np.searchsorted(begin, text_at[1:] - 1)] = False
        return begin[own], end[own]

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """All texts' ids in one array, and where each text's begin (plus the total).  Null: none."""
        n = len(texts)
        listed = [x or "" for x in texts.to_pylist()]
        odd = [i for i, x in enumerate(listed) if self.kind == "whole" or _ODD.search(x)]
        apart = dict(zip(odd, self.whole([listed[i] for i in odd]), strict=True))
        if odd:
            listed = ["" if i in apart else x for i, x in enumerate(listed)]
            texts = pa.array(listed, pa.large_string())
        data, text_at = joined(texts)
        begin, end = self._pieces(data, text_at)
        flat, size = self._look_up(data, begin, end)
        total = np.concatenate(([0], np.cumsum(size)))
        of_text = total[np.searchsorted(begin, text_at)]
        if not apart:
            return flat, of_text
        parts = [apart.get(i, flat[of_text[i]:of_text[i + 1]]) for i in range(n)]
        return np.concatenate([np.zeros(0, self.type), *parts]), np.concatenate(([0], np.cumsum([len(x) for x in parts])))

    def _look_up(self, data, begin, end) -> tuple[np.ndarray, np.ndarray]:
        if not len(begin):
            return np.zeros(0, self.type), np.zeros(0, np.int64)
        h = [span_hashes(data, begin, end, k) for k in (0, 1)]
        slot = (h[0] >> np.uint64(64 - SLOT_BITS)).astype(np.int64)
        size = self.size[slot]
        known = (self.keys[0][slot] == h[0]) & (self.keys[1][slot] == h[1]) & (size >= 0)
        at = self.at[slot]
        missed = np.flatnonzero(~known)
        heap = self.heap
        if len(missed):
            order = missed[np.lexsort((h[1][missed], h[0][missed]))]
            fresh = np.ones(len(order), bool)
            fresh[1:] = (h[0][order][1:] != h[0][order][:-1]) | (h[1][order][1:] != h[1][order][:-1])
            lead = order[fresh]
            raw = data.tobytes()
            made = self._fresh([raw[a:b] for a, b in zip(begin[lead].tolist(), end[lead].tolist(), strict=True)])
            n = np.fromiter(map(len, made), np.int64, len(made))
            ids = np.fromiter((i for x in made for i in x), self.type, n.sum())
            # this slice's pieces lie behind those of the table
            group = np.cumsum(fresh) - 1
            start = np.cumsum(n) - n + self.used
            at[order], size[order] = start[group], n[group]
            if self.used + len(ids) <= len(heap):
                heap[self.used:self.used + len(ids)] = ids
                self.used += len(ids)
                self.keys[0][slot[lead]], self.keys[1][slot[lead]] = h[0][lead], h[1][lead]
                self.at[slot[lead]], self.size[slot[lead]] = start, n
            else:
                heap = np.concatenate((heap[:self.used], ids))
                self.size[:] = -1
                self.used = 0
        ends = np.cumsum(size)
        return heap[np.arange(ends[-1]) + np.repeat(at - (ends - size), size)], size


@functools.lru_cache(2)
def encoder(path: str) -> Encoder:
    """One for each file in a worker process."""
    return Encoder(path)
