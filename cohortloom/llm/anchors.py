"""Anchors: places in byte strings that equal stretches choose alike, wherever they stand."""

from __future__ import annotations

import numpy as np

#: Bytes worked on at once.
CHUNK = 1 << 19
#: Any odd multipliers and any fixed random numbers do; equal ones give equal anchors.
MULTIPLIERS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)
PLACE_BITS = 20


class Anchors:
    """Of every `stretch` bytes in a row the substring of a quarter that with the least hash."""

    def __init__(self, stretch: int):
        self.stretch = stretch
        self.size = max(stretch // 4, 1)
        self.window = stretch - self.size + 1
        length = CHUNK + 4 * stretch
        noise = np.random.default_rng(11)
        self.tables, self.up, self.down = [], [], []
        for m in MULTIPLIERS:
            self.tables.append(noise.integers(0, 1 << 63, 256, np.uint64) << np.uint64(1) | np.uint64(1))
            steps = np.full(length + 1, m, np.uint64)
            back = np.full(length + 1, pow(m, -1, 1 << 64), np.uint64)
            steps[0] = back[0] = 1
            self.up.append(np.multiply.accumulate(steps))
            self.down.append(np.multiply.accumulate(back))

    def sums(self, content: np.ndarray, which: int) -> np.ndarray:
        """Running sums from which the hash of any stretch of the content is taken."""
        out = np.zeros(len(content) + 1, np.uint64)
        np.cumsum(self.tables[which][content] * self.up[which][: len(content)], out=out[1:])
        return out

    def hashes(self, sums: np.ndarray, begin: np.ndarray, end: np.ndarray, which: int) -> np.ndarray:
        h = (sums[end] - sums[begin]) * self.down[which][begin]
        h ^= h >> np.uint64(32)
        h *= np.uint64(0xD6E8FEB86659FD93)
        return h ^ (h >> np.uint64(29))

    def least(self, key: np.ndarray) -> np.ndarray:
        """The least of each `window` keys in a row."""
        w, n = self.window, len(key)
        whole = np.full(-(-n // w) * w, ~np.uint64(0))
        whole[:n] = key
        blocks = whole.reshape(-1, w)
        left = np.minimum.accumulate(blocks, axis=1).ravel()
        right = np.minimum.accumulate(blocks[:, ::-1], axis=1)[:, ::-1].ravel()
        return np.minimum(right[: n - w + 1], left[w - 1 : n])

    def find(self, content: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, ...]:
        """(text, anchor, context, begin, end, place) of the anchors of all texts, as arrays.

        Text i holds the bytes offsets[i] to offsets[i + 1] of the content. Each stretch chooses one
        anchor, of equal hashes the first; those that choose the same one follow each other. begin
        and end bound, in the text, the bytes of these stretches, the anchor is `place` bytes behind
        begin. anchor is the hash of the substring, context that of the bytes and the place. Equal
        stretches have equal anchors, at the same distance.
        """
        parts = []
        begin, total = int(offsets[0]), int(offsets[-1])
        last = total - self.stretch + 1
        while begin < last:
            stop = min(begin + CHUNK, last)
            own = content[begin : stop + self.stretch - 1]
            sums = [self.sums(own, which) for which in (0, 1)]
            start = np.arange(begin, stop)
            text = np.searchsorted(offsets, start, "right") - 1
            inside = np.flatnonzero(start + self.stretch <= offsets[text + 1])
            at = np.arange(len(own) - self.size + 1)
            key = self.hashes(sums[0], at, at + self.size, 0)
            mask = np.uint64((1 << PLACE_BITS) - 1)
            key = (key & ~mask) | at.astype(np.uint64)
            chosen = (self.least(key)[inside] & mask).astype(np.int64)
            cuts = np.flatnonzero(np.diff(chosen)) + 1
            first = inside[np.concatenate([[0], cuts])] if len(inside) else inside
            final = inside[np.concatenate([cuts, [len(inside)]]) - 1] if len(inside) else inside
            begin, here = stop, begin
            if stop < last and len(first) and here + final[-1] == stop - 1:
                # The stretches of the last anchor may go on: it is left to the next chunk.
                begin, first, final = here + int(first[-1]), first[:-1], final[:-1]
            if not len(first):
                continue
            anchor_at = chosen[np.searchsorted(inside, first)]
            anchor = self.hashes(sums[0], anchor_at, anchor_at + self.size, 0)
            place = anchor_at - first
            context = self.hashes(sums[1], first, final + self.stretch, 1)
            context += place.astype(np.uint64) * np.uint64(MULTIPLIERS[0])
            text = text[first]
            low = first + here - offsets[text]
            parts.append(
                (text, anchor.view(np.int64), context.view(np.int64), low,
                 low + (final - first) + self.stretch, place)
            )
        if not parts:
            return tuple(np.zeros(0, np.int64) for _ in range(6))
        return tuple(np.concatenate(column) for column in zip(*parts))
