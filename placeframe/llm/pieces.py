"""Pieces of texts for byte-level BPE, and the vocabulary file."""

from __future__ import annotations

import heapq
import json
import re
from collections.abc import Sequence
from dataclasses import dataclass
from functools import cache, cached_property

import numpy as np

from placeframe.llm.textblocks import gpt_tokens, points, span_hashes

#: Longer texts are cut before a space that follows another sign, where a piece always begins.
LONG = 1 << 21
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Longer pieces are merged one by one.
LONG_PIECE = 256
NO_MERGE = 1 << 62


@dataclass(frozen=True)
class Vocabulary:
    """A byte-level BPE vocabulary; symbols are byte strings."""

    ids: dict[bytes, int]
    ranks: dict[tuple[bytes, bytes], int]
    special: dict[str, int]

    @cached_property
    def pairs(self) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
        """Adjacent ids that merge (the first times 2^32 plus the second, sorted), the rank
        of each, the id that each rank's merge gives, and the id of each byte."""
        ids = self.ids
        made = np.array([ids[a + b] for a, b in self.ranks], np.int64)
        keys = np.array([ids[a] << 32 | ids[b] for a, b in self.ranks], np.int64)
        rank = np.fromiter(self.ranks.values(), np.int64, len(keys))
        by_rank = np.zeros(int(rank.max()) + 1 if len(rank) else 0, np.int64)
        by_rank[rank] = made
        order = np.argsort(keys)
        return keys[order], rank[order], by_rank, np.array([ids.get(bytes([i]), -1) for i in range(256)], np.int64)

    @cached_property
    def rank_by_pair(self) -> dict[int, int]:
        return dict(zip(self.pairs[0].tolist(), self.pairs[1].tolist()))

    def rank_of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The ranks of pairs of ids; ``NO_MERGE`` where they don't merge."""
        keys, rank, *_ = self.pairs
        if not len(keys):
            return np.full(len(left), NO_MERGE)
        key = left << 32 | right
        at = np.minimum(np.searchsorted(keys, key), len(keys) - 1)
        return np.where(keys[at] == key, rank[at], NO_MERGE)

    def encoded(self, pieces: Sequence[bytes]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all pieces end to end, and how many each has: in each piece the lowest-ranked
        adjacent pair (the first of equal ones) is merged until none is left. All pieces merge
        one pair a round, and a piece leaves when it has none; very long ones go by a heap."""
        short = [p if len(p) <= LONG_PIECE else b"" for p in pieces]
        owner = np.repeat(np.arange(len(short)), np.fromiter(map(len, short), np.int64, len(short)))
        _, _, by_rank, byte_ids = self.pairs
        ids = byte_ids[np.frombuffer(b"".join(short), np.uint8)]
        if (ids < 0).any():
            raise KeyError("a byte that the vocabulary doesn't have")
        rank = np.full(len(ids), NO_MERGE)  # of each id with the next one of its piece
        inner = np.flatnonzero(owner[1:] == owner[:-1])
        rank[inner] = self.rank_of(ids[inner], ids[inner + 1])
        ended: list[tuple[np.ndarray, np.ndarray]] = []
        while len(ids):
            begins = np.flatnonzero(np.append(True, owner[1:] != owner[:-1]))
            least = np.repeat(np.minimum.reduceat(rank, begins), np.diff(np.append(begins, len(ids))))
            keep = least != NO_MERGE
            ended.append((owner[~keep], ids[~keep]))
            at = np.flatnonzero((rank == least) & keep)
            at = at[np.flatnonzero(np.diff(owner[at], prepend=-1))]  # the first of each piece
            ids[at] = by_rank[rank[at]]
            keep[at + 1] = False
            at = (np.cumsum(keep) - 1)[at]
            owner, ids, rank = owner[keep], ids[keep], rank[keep]
            for i in (at, at[at > 0] - 1):
                rank[i] = NO_MERGE
                i = i[i + 1 < len(ids)]
                i = i[owner[i] == owner[i + 1]]
                rank[i] = self.rank_of(ids[i], ids[i + 1])
        for k, piece in enumerate(pieces):
            if len(piece) > LONG_PIECE:
                own = self.encoded_long(piece)
                ended.append((np.full(len(own), k), np.array(own, np.int64)))
        if not ended:
            return np.zeros(0, np.int64), np.zeros(len(pieces), np.int64)
        owner, ids = (np.concatenate(x) for x in zip(*ended))
        return ids[np.argsort(owner, kind="stable")], np.bincount(owner, minlength=len(pieces))

    def encoded_long(self, piece: bytes) -> list[int]:
        """The ids of one piece by a heap of the open pairs; the time doesn't grow with the square of its length."""
        _, _, by_rank, byte_ids = self.pairs
        rank_of = self.rank_by_pair
        ids, n = byte_ids[np.frombuffer(piece, np.uint8)].tolist(), len(piece)
        before, after = list(range(-1, n - 1)), list(range(1, n + 1))
        pairs = (ids[i] << 32 | ids[i + 1] for i in range(n - 1))
        heap = [(rank_of[p], i, p) for i, p in enumerate(pairs) if p in rank_of]
        heapq.heapify(heap)
        while heap:
            rank, i, pair = heapq.heappop(heap)
            j = after[i]
            if ids[i] < 0 or j >= n or ids[i] << 32 | ids[j] != pair:
                continue  # one of the two was merged since
            ids[i], ids[j] = int(by_rank[rank]), -1
            after[i] = after[j]
            if after[i] < n:
                before[after[i]] = i
            for x in (before[i], i):
                y = after[x] if x >= 0 else n
                if y < n and (pair := ids[x] << 32 | ids[y]) in rank_of:
                    heapq.heappush(heap, (rank_of[pair], x, pair))
        return [i for i in ids if i >= 0]


@cache
def byte_letters() -> dict[str, int]:
    """The printable stand-in of each byte in vocabulary files of this kind."""
    plain = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(plain)]
    return {chr(b): b for b in plain} | {chr(256 + i): b for i, b in enumerate(rest)}


def check_settings(data: dict) -> None:
    """Raises on settings that these operators don't follow: other ones would give other tokens."""
    model, cut = data["model"], data.get("pre_tokenizer") or {}
    cuts = cut.get("type") == "ByteLevel" and not cut.get("add_prefix_space") and cut.get("use_regex", True)
    whole = ("dropout", "unk_token", "continuing_subword_prefix", "end_of_word_suffix", "byte_fallback", "ignore_merges")
    wrong = [k for k in whole if model.get(k)]
    wrong += [f"added {x['content']!r}" for x in data.get("added_tokens", []) if any(x.get(k) for k in ("single_word", "lstrip", "rstrip", "normalized"))]
    wrong += ["model type"] * (model.get("type", "BPE") != "BPE") + ["pre_tokenizer"] * (not cuts) + ["normalizer"] * (data.get("normalizer") is not None)
    wrong += ["decoder"] * ((data.get("decoder") or {}).get("type", "ByteLevel") != "ByteLevel")
    if wrong:
        raise ValueError(f"settings of the vocabulary that aren't supported: {', '.join(wrong)}")


def parse_vocabulary(raw: bytes) -> Vocabulary:
    data = json.loads(raw)
    check_settings(data)
    of = byte_letters()
    special = {x["content"]: x["id"] for x in data.get("added_tokens", [])}
    as_bytes = lambda s: bytes(of[c] for c in s)
    pairs = [tuple(m.split(" ")) if isinstance(m, str) else tuple(m) for m in data["model"]["merges"]]
    return Vocabulary(
        {as_bytes(s): i for s, i in data["model"]["vocab"].items() if s not in special},
        {(as_bytes(a), as_bytes(b)): r for r, (a, b) in enumerate(pairs)},
        special,
    )


@dataclass
class Parts:
    """Texts cut at special strings (and long ones at spaces): each part belongs
    to ``owner``; a part with ``special`` >= 0 is that token, the others are text."""

    texts: list[str]
    owner: np.ndarray
    special: np.ndarray


def parts_of(texts: Sequence[str | None], special: dict[str, int], long: int = LONG) -> Parts:
    out: list[str] = []
    owner: list[int] = []
    ids: list[int] = []
    split = re.compile("(" + "|".join(map(re.escape, sorted(special, key=len, reverse=True))) + ")") if special else None
    for i, text in enumerate(texts):
        if not text:
            continue
        found = split.split(text) if split and any(s in text for s in special) else [text]
        for k, part in enumerate(found):
            if k % 2:
                out.append("")
                owner.append(i)
                ids.append(special[part])
                continue
            while len(part) > long and (cut := _CUT.search(part, long)):
                out.append(part[: cut.start()])
                owner.append(i)
                ids.append(-1)
                part = part[cut.start() :]
            if part:
                out.append(part)
                owner.append(i)
                ids.append(-1)
    return Parts(out, np.array(owner, np.int64), np.array(ids, np.int64))


def distinct_pieces(texts: Sequence[str]) -> tuple[list[str], np.ndarray, np.ndarray]:
    """The distinct pieces of the texts, each piece's index among them in order,
    and the bounds of each text's pieces."""
    cps, bounds = points(texts)
    begins = gpt_tokens(cps, bounds)
    ends = np.append(begins[1:], len(cps))
    _, first, inverse = np.unique(span_hashes(cps, begins, ends), return_index=True, return_inverse=True)
    joined = "".join(texts)
    lows, highs = begins[first].tolist(), ends[first].tolist()
    return [joined[a:b] for a, b in zip(lows, highs)], inverse, np.searchsorted(begins, bounds)
