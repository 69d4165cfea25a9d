"""A byte-pair vocabulary compiled into a deterministic automaton.

The automaton reads tokens. Its language is the set of token sequences that byte-pair merging
produces, so a text has exactly one path and that path is its encoding. It starts with one state
that loops on every byte. Each merge (a, b) -> c adds one gadget, in merge order: wherever an arc a
is followed by an arc b, an arc c goes from the source of a to the target of b, and after a the arc
b is removed, which splits the state behind a off if other tokens share it.

Two tokens share a state while the same arcs leave them, and share a label class while the same
states have them; the table holds one bit for each state and label class.
"""

from __future__ import annotations

import json
import zlib

import numpy as np


def byte_symbols() -> list[str]:
    """The printable character that stands for each byte in a byte-level vocabulary."""
    shown = [*range(33, 127), *range(161, 173), *range(174, 256)]
    hidden = [b for b in range(256) if b not in shown]
    table = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    return [table[b] for b in range(256)]


def read_vocabulary(path: str) -> tuple[list[bytes], list[tuple[int, int, int]], dict[str, int]]:
    """Token bytes by id, merges as (left, right, result) ids in order, special tokens."""
    with open(path, encoding="utf-8") as file:
        model = json.load(file)
    values = {symbol: byte for byte, symbol in enumerate(byte_symbols())}
    vocab = model["model"]["vocab"]
    special = {t["content"]: t["id"] for t in model["added_tokens"]}
    labels = [b""] * (max([*vocab.values(), *special.values()]) + 1)
    for token, k in vocab.items():
        labels[k] = bytes(values[c] for c in token)
    for token, k in special.items():
        labels[k] = token.encode()
    pairs = [m.split(" ") if isinstance(m, str) else m for m in model["model"]["merges"]]
    return labels, [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs], special


class Bits:
    """The growing table of states x label classes."""

    def __init__(self):
        self.states = self.classes = 1
        self.table = np.full((1024, 128), 0, np.uint8)
        self.table[0, 0] = 1

    def copy_state(self, state: int) -> int:
        if self.states == len(self.table):
            self.table = np.concatenate([self.table, np.zeros_like(self.table)])
        self.table[self.states] = self.table[state]
        self.states += 1
        return self.states - 1

    def copy_class(self, label: int) -> int:
        if self.classes == 8 * self.table.shape[1]:
            self.table = np.concatenate([self.table, np.zeros_like(self.table)], axis=1)
        new = self.classes
        column = (self.table[: self.states, label >> 3] >> (label & 7)) & 1
        self.table[: self.states, new >> 3] |= column << (new & 7)
        self.classes += 1
        return new

    def has(self, state: int, label: int) -> bool:
        return bool(self.table[state, label >> 3] >> (label & 7) & 1)

    def remove(self, state: int, label: int) -> None:
        self.table[state, label >> 3] &= 255 ^ (1 << (label & 7))


class MergeAutomaton:
    """Compiled transitions; encoding follows them, decoding emits `labels`."""

    def __init__(self, labels: list[bytes], merges: list[tuple[int, int, int]]):
        self.labels = labels
        bytes_ = {label: k for k, label in enumerate(labels) if len(label) == 1}
        bits = Bits()
        state = dict.fromkeys(bytes_.values(), 0)
        label = dict.fromkeys(bytes_.values(), 0)
        sharing_state, sharing_class = [len(state)], [len(label)]

        def own_state(token: int) -> None:
            if sharing_state[state[token]] > 1:
                sharing_state[state[token]] -= 1
                state[token] = bits.copy_state(state[token])
                sharing_state.append(1)

        def own_class(token: int) -> None:
            if sharing_class[label[token]] > 1:
                sharing_class[label[token]] -= 1
                label[token] = bits.copy_class(label[token])
                sharing_class.append(1)

        for a, b, c in merges:
            if a not in state or b not in state or not bits.has(state[a], label[b]):
                continue  # no path has a before b, so the merge never applies
            state[c] = state[b]
            sharing_state[state[c]] += 1
            if a != b:
                label[c] = label[a]
                sharing_class[label[c]] += 1
            own_state(a)
            own_class(b)
            bits.remove(state[a], label[b])
            if a == b:  # a run is merged from the left: a cannot stand before aa, aa can before a
                label[c] = label[a]
                sharing_class[label[c]] += 1
        self.width = (bits.classes + 7) // 8
        self.table = bits.table[: bits.states, : self.width].tobytes()
        self.state, self.label = state, label
        self._index()

    def __getstate__(self):
        tokens = np.array(list(self.state), np.int64)
        packed = [np.array([d[k] for k in self.state], np.int32) for d in (self.state, self.label)]
        return self.labels, self.width, zlib.compress(self.table, 1), tokens, *packed

    def __setstate__(self, saved):
        self.labels, self.width, table, tokens, state, label = saved
        self.table = zlib.decompress(table)
        self.state = dict(zip(tokens.tolist(), state.tolist()))
        self.label = dict(zip(tokens.tolist(), label.tolist()))
        self._index()

    def _index(self) -> None:
        """Arcs by the bytes of their labels, as a tree, and for each token the next shorter one."""
        self.whole = {self.labels[k]: k for k in self.state}
        self.step: dict[int, int] = {}
        token_at = [-1]
        for text, k in self.whole.items():
            node = 0
            for byte in text:
                key = node << 8 | byte
                if key not in self.step:
                    self.step[key] = len(token_at)
                    token_at.append(-1)
                node = self.step[key]
            token_at[node] = k
        self.reach = max(map(len, self.whole))
        self.token_at = token_at
        self.shorter = [-1] * len(self.labels)
        for text, k in self.whole.items():
            self.shorter[k] = next((self.whole[text[:n]] for n in range(len(text) - 1, 0, -1) if text[:n] in self.whole), -1)
        # the same as arrays, for many words at once
        self._bits = np.frombuffer(self.table, np.uint8)
        self._token_at, self._shorter = np.array(token_at, np.int32), np.array(self.shorter, np.int32)
        self._state, self._label = np.zeros(len(self.labels), np.int64), np.zeros(len(self.labels), np.int64)
        tokens = list(self.state)
        self._state[tokens], self._label[tokens] = list(self.state.values()), list(self.label.values())
        self._size = np.array([len(t) for t in self.labels], np.int32)
        self._steps(np.array(list(self.step), np.int64), np.array(list(self.step.values()), np.int32))

    def _steps(self, keys: np.ndarray, nodes: np.ndarray) -> None:
        """The tree's steps in a hash table with linear probing."""
        self._slots = 1 << max(4, int(4 * len(keys)).bit_length())
        self._key, self._node = np.full(self._slots, -1, np.int64), np.full(self._slots, -1, np.int32)
        slot = self._slot(keys)
        while len(keys):
            free = self._key[slot] < 0
            self._key[slot[free]] = keys[free]
            here = self._key[slot] == keys
            self._node[slot[here]] = nodes[here]
            keys, nodes, slot = keys[~here], nodes[~here], (slot[~here] + 1) % self._slots

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return (keys * 0x9E3779B1 & 0xFFFFFFFF) >> (32 - self._slots.bit_length() + 1)

    def _walk(self, node: np.ndarray, byte: np.ndarray) -> np.ndarray:
        """The nodes that steps lead to, -1 where there is none."""
        key = node << 8 | byte
        slot = self._slot(key)
        seen = self._key[slot]
        out = np.where(seen == key, self._node[slot], -1)
        left = np.flatnonzero((seen != key) & (seen >= 0))
        while len(left):
            slot[left] = (slot[left] + 1) % self._slots
            seen = self._key[slot[left]]
            hit = seen == key[left]
            out[left[hit]] = self._node[slot[left[hit]]]
            left = left[~hit & (seen >= 0)]
        return out.astype(np.int64)

    def _longest(self, text: np.ndarray, here: np.ndarray, end: np.ndarray) -> np.ndarray:
        best = np.full(len(here), -1, np.int32)
        live, node, at = np.arange(len(here)), np.zeros(len(here), np.int64), here.copy()
        while len(live):
            node = self._walk(node, text[at])
            on = node >= 0
            live, node, at = live[on], node[on], at[on] + 1
            token = self._token_at[node]
            good = token >= 0
            best[live[good]] = token[good]
            on = at < end[live]
            live, node, at = live[on], node[on], at[on]
        return best

    def encode_many(self, words: list[bytes]) -> list[bytes]:
        """The ids of many words as packed little-endian uint32: `encode`, for all words in step."""
        if not words:
            return []
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        text = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        ends = np.cumsum(sizes)
        begin = ends - sizes
        chosen = np.full(len(text) + 1, -1, np.int32)  # by the byte where a token begins
        came_from = np.full(len(text) + 1, -1, np.int64)
        dead = np.zeros(len(text) + 1, bool)
        word = np.flatnonzero(sizes > 0)
        here, end = begin[word].copy(), ends[word]
        token = self._longest(text, here, end)
        while len(word):
            kind, there = self._label[token], here + self._size[token]
            back = came_from[here]
            state = self._state[chosen[back]]
            free = here == begin[word]
            fits = (self._bits[state * self.width + (kind >> 3)] >> (kind & 7).astype(np.uint8) & 1).astype(bool)
            good = (free | fits) & ~(dead[there] & (there < end))
            chosen[here[good]] = token[good]
            inner = np.flatnonzero(good & (there < end))
            came_from[there[inner]] = here[inner]
            bad = np.flatnonzero(~good)
            token[bad] = self._shorter[token[bad]]
            here[inner] = there[inner]
            token[inner] = self._longest(text, here[inner], end[inner])
            stuck = bad[token[bad] < 0]
            while len(stuck):
                dead[here[stuck]] = True
                here[stuck] = came_from[here[stuck]]
                token[stuck] = self._shorter[chosen[here[stuck]]]
                stuck = stuck[token[stuck] < 0]
            on = np.flatnonzero(~(good & (there >= end)))
            word, here, end, token = word[on], here[on], end[on], token[on]
        count = np.zeros(len(words), np.int64)
        starts, at, live = [], begin.copy(), np.flatnonzero(sizes > 0)
        while len(live):
            starts.append(at[live])
            count[live] += 1
            at[live] += self._size[chosen[at[live]]]
            live = live[at[live] < ends[live]]
        ids = chosen[np.sort(np.concatenate(starts))] if starts else chosen[:0]
        packed = ids.astype("<u4").tobytes()
        stop = 4 * np.cumsum(count)
        return [packed[a:b] for a, b in zip((stop - 4 * count).tolist(), stop.tolist())]

    def encode(self, word: bytes) -> list[int]:
        """The token ids of one pre-split word, in time linear in its length.

        Tries arcs from the longest label down. A prefix of the word has one path at most, so a
        position that led nowhere once is never tried again.
        """
        if word in self.whole:
            return [self.whole[word]]
        if not word:
            return []
        table, width, state, label = self.table, self.width, self.state, self.label
        labels, shorter, step, token_at = self.labels, self.shorter, self.step, self.token_at
        path: list[int] = []
        dead = bytearray(len(word) + 1)
        here, end, row, token = 0, len(word), -1, -1
        while True:
            if token < 0:  # a new position: the longest arc that can be read
                node = 0
                for byte in word[here : here + self.reach]:
                    node = step.get(node << 8 | byte, -1)
                    if node < 0:
                        break
                    if token_at[node] >= 0:
                        token = token_at[node]
            there, kind = here + len(labels[token]), label[token]
            if not dead[there] and (row < 0 or table[row + (kind >> 3)] >> (kind & 7) & 1):
                path.append(token)
                if there == end:
                    return path
                here, row, token = there, width * state[token], -1
            else:
                token = shorter[token]
                while token < 0:
                    dead[here] = 1
                    token = path.pop()
                    here -= len(labels[token])
                    row = width * state[path[-1]] if path else -1
                    token = shorter[token]
