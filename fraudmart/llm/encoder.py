"""Token ids of whole texts with a tokenizer file.

``word_bpe`` style tokenizers drop white space before they look at a text, so
a text's ids are its white-space separated chunks' ids in order. ``Encoder``
checks that on the file's own settings and then encodes each distinct chunk
once per worker, in a bounded memory; any other tokenizer encodes text by text.
Either way every id comes from the tokenizers library.

Texts of Latin-1 letters are lowered first, and a full stop or comma after a
letter or digit and before white space becomes a chunk of its own: both leave
the ids as they are and make the distinct chunks fewer. Where such a mark
follows other punctuation the two are one piece, so that text is encoded by its
raw chunks.
"""

from __future__ import annotations

import json
import os
from functools import lru_cache
from itertools import chain

import numpy as np

#: Chunks remembered per worker; when full, those seen only once are forgotten.
MEMO_CHUNKS = 700_000
LATIN_LETTERS = bytes(c for c in range(256) if chr(c).isalpha())
ENDS_PIECE = frozenset(LATIN_LETTERS + b"0123456789")


def ignores_white_space(settings: dict) -> bool:
    """Whether the settings turn white space into blanks and then keep only
    matches of patterns that hold no white space."""
    norm = settings.get("normalizer") or {}
    steps = norm.get("normalizers", [norm] if norm else [])
    for s in steps:
        blank = s["type"] == "Replace" and s["pattern"] == {"Regex": "\\s+"} and s["content"] == " "
        if s["type"] not in ("NFC", "Lowercase") and not blank:
            return False
    pre = (settings.get("pre_tokenizer") or {}).get("pretokenizers", [])
    return (len(pre) == 2 and pre[0]["type"] == "Split" and pre[0]["behavior"] == "Removed"
            and pre[0]["invert"] and pre[0]["pattern"].get("Regex", "").endswith("|[^\\s\\p{L}\\p{N}]+")
            and "[\\p{L}]+" in pre[0]["pattern"]["Regex"].split("|")
            and pre[1]["type"] == "ByteLevel" and not pre[1]["add_prefix_space"] and not pre[1]["use_regex"]
            and settings["model"].get("end_of_word_suffix") == "</w>")


class _Growing:
    """A numpy array with room to append."""

    def __init__(self, dtype):
        self.n, self.room = 0, np.empty(1 << 12, dtype)

    def extend(self, values: np.ndarray) -> None:
        if self.n + len(values) > len(self.room):
            room = np.empty(2 * (self.n + len(values)), self.room.dtype)
            room[:self.n] = self.room[:self.n]
            self.room = room
        self.room[self.n:self.n + len(values)] = values
        self.n += len(values)

    @property
    def all(self) -> np.ndarray:
        return self.room[:self.n]


class _Chunks(dict):
    """chunk -> number; new chunks are numbered as they are met."""

    def __init__(self):
        super().__init__()
        self.new: list[bytes] = []

    def __missing__(self, chunk: bytes) -> int:
        n = self[chunk] = len(self)
        self.new.append(chunk)
        return n


class _Memo:
    """Ids by chunk. ``learn`` gives the ids of new chunks."""

    def __init__(self, learn, dtype):
        self.learn, self.dtype = learn, dtype
        self._reset()

    def _reset(self) -> None:
        self.chunks = _Chunks()
        self.flat, self.starts, self.lens = _Growing(self.dtype), _Growing(np.int64), _Growing(np.int64)
        self.seen, self.ends_piece = _Growing(np.int64), _Growing(bool)

    def numbers(self, split: list[list[bytes]]) -> np.ndarray:
        """Chunk numbers of all texts in order."""
        if len(self.chunks) > MEMO_CHUNKS:
            self._forget()
        n = sum(map(len, split))
        rows = np.fromiter(map(self.chunks.__getitem__, chain.from_iterable(split)), np.int64, n)
        if self.chunks.new:
            new, self.chunks.new = self.chunks.new, []
            self._add(new, *self.learn(new))
        self.seen.all[:] += np.bincount(rows, minlength=self.seen.n)
        return rows

    def _add(self, new: list[bytes], flat: np.ndarray, lens: np.ndarray) -> None:
        self.starts.extend(self.flat.n + np.cumsum(lens) - lens)
        self.flat.extend(flat)
        self.lens.extend(lens)
        self.seen.extend(np.zeros(len(new), np.int64))
        self.ends_piece.extend(np.fromiter((c[-1] in ENDS_PIECE for c in new), bool, len(new)))

    def _forget(self) -> None:
        again = np.flatnonzero(self.seen.all > 1)
        if len(again) > MEMO_CHUNKS // 2:
            again = again[np.argsort(-self.seen.all[again], kind="stable")[:MEMO_CHUNKS // 2]]
        keys = np.array(list(self.chunks), object)[again].tolist()
        lens = self.lens.all[again]
        flat = self.ids(again, lens)
        self._reset()
        self.chunks.update(zip(keys, range(len(keys))))
        self._add(keys, flat, lens)

    def ids(self, rows: np.ndarray, lens: np.ndarray) -> np.ndarray:
        ends = np.cumsum(lens)
        total = int(ends[-1]) if len(ends) else 0
        return self.flat.all[np.repeat(self.starts.all[rows] - ends + lens, lens) + np.arange(total)]


class Encoder:
    def __init__(self, path: str):
        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")
        from tokenizers import Tokenizer, normalizers, pre_tokenizers

        self.tok = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as f:
            self.by_chunk = ignores_white_space(json.load(f))
        self.dtype = np.uint16 if self.tok.get_vocab_size() <= 1 << 16 else np.uint32
        if not self.by_chunk:
            return
        # Lower-case letter runs skip the general patterns: each is one piece.
        self.letters = Tokenizer.from_file(path)
        self.letters.normalizer = normalizers.Sequence([])
        self.letters.pre_tokenizer = pre_tokenizers.Sequence([
            pre_tokenizers.WhitespaceSplit(),
            pre_tokenizers.ByteLevel(add_prefix_space=False, use_regex=False)])
        vocab = self.tok.get_vocab()
        self.ends = np.zeros(max(vocab.values()) + 1, bool)
        self.ends[[i for t, i in vocab.items() if t.endswith("</w>")]] = True
        self.latin = _Memo(self._learn_latin, self.dtype)
        self.raw = _Memo(self._learn_raw, self.dtype)

    def _ids(self, tok, texts: list[str]) -> list[list[int]]:
        return [e.ids for e in tok.encode_batch_fast(texts, add_special_tokens=False)]

    def _flat(self, ids: list[list[int]]) -> np.ndarray:
        return np.fromiter(chain.from_iterable(ids), self.dtype, sum(map(len, ids)))

    def _learn_raw(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        ids = self._ids(self.tok, [c.decode("utf-8") for c in new])
        return self._flat(ids), np.fromiter(map(len, ids), np.int64, len(ids))

    def _learn_latin(self, new: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
        runs = [not c.translate(None, LATIN_LETTERS) for c in new]
        letters = [c.decode("latin-1") for c, r in zip(new, runs) if r]
        whole = [c.decode("latin-1") for c, r in zip(new, runs) if not r]
        first = self._flat(self._ids(self.letters, [" ".join(letters[i:i + 64]) for i in range(0, len(letters), 64)]))
        ends = np.flatnonzero(self.ends[first]) + 1
        if len(ends) != len(letters) or (len(ends) and ends[-1] != len(first)):
            raise RuntimeError("a letter run is not one piece of this tokenizer")
        rest = self._ids(self.tok, whole) if whole else []
        lens = np.empty(len(new), np.int64)
        runs = np.array(runs, bool)
        lens[runs] = np.diff(ends, prepend=0)
        lens[~runs] = np.fromiter(map(len, rest), np.int64, len(rest))
        flat = np.empty(int(lens.sum()), self.dtype)
        of_run = np.repeat(runs, lens)
        flat[of_run] = first
        flat[~of_run] = self._flat(rest)
        return flat, lens

    def _latin_chunks(self, text: str) -> list[bytes] | None:
        if "<|" in text:  # special tokens are matched before lowering
            return None
        try:
            b = text.lower().encode("latin-1")
        except UnicodeEncodeError:
            return None
        for mark in (b".", b","):
            b = b.replace(mark + b" ", b" " + mark + b" ").replace(mark + b"\n", b" " + mark + b"\n")
        return b.split()

    def _pieces(self, memo: _Memo, split: list[list[bytes]]):
        rows = memo.numbers(split)
        per = np.fromiter(map(len, split), np.int64, len(split))
        return rows, memo.lens.all[rows], np.concatenate([[0], np.cumsum(per)])

    def _encode(self, texts: list[str | None], finish) -> list:
        """``finish(memo, rows, lens, bounds)`` per group of texts, in the
        order of the texts."""
        out: list = [None] * len(texts)
        split = [self._latin_chunks(t) if t else [] for t in texts]
        plain = [i for i, s in enumerate(split) if s is not None]
        rows, lens, at = self._pieces(self.latin, [split[i] for i in plain])
        # a mark split from punctuation before it: not the same pieces
        marks = np.zeros(self.latin.starts.n, bool)
        marks[[n for c in (b".", b",") if (n := self.latin.chunks.get(c)) is not None]] = True
        cut = marks[rows]
        cut[1:] &= ~self.latin.ends_piece.all[rows[:-1]]
        wrong = set(np.unique(np.searchsorted(at, np.flatnonzero(cut), side="right") - 1).tolist())
        for k, x in enumerate(finish(self.latin, rows, lens, at)):
            if k not in wrong:
                out[plain[k]] = x
        rest = [i for i, s in enumerate(split) if s is None] + [plain[k] for k in sorted(wrong)]
        if rest:
            rows, lens, at = self._pieces(self.raw, [texts[i].encode("utf-8").split() for i in rest])
            for i, x in zip(rest, finish(self.raw, rows, lens, at)):
                out[i] = x
        return out

    def lengths(self, texts: list[str | None]) -> np.ndarray:
        if not self.by_chunk:
            return np.array([len(x) for x in self._ids(self.tok, [t or "" for t in texts])], np.int64)

        def finish(memo, rows, lens, at):
            total = np.concatenate([[0], np.cumsum(lens)])
            return total[at[1:]] - total[at[:-1]]

        return np.array(self._encode(texts, finish), np.int64)

    def __call__(self, texts: list[str | None]) -> list[np.ndarray]:
        if not self.by_chunk:
            return [np.array(x, self.dtype) for x in self._ids(self.tok, [t or "" for t in texts])]

        def finish(memo, rows, lens, at):
            ids, ends = memo.ids(rows, lens), np.concatenate([[0], np.cumsum(lens)])
            return [ids[a:b] for a, b in zip(ends[at[:-1]], ends[at[1:]])]

        return self._encode(texts, finish)


@lru_cache(maxsize=1)
def worker_encoder(path: str, run: str) -> Encoder:
    """The encoder of a file, kept for the next task that this worker has in the same
    run: loading it takes as long as encoding megabytes of texts."""
    return Encoder(path)
