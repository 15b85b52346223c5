"""SentencePiece encoding and decoding, with distinct segmentations sampled without replacement.

A text is one blank and itself, cut into units between any two characters that stand side by side in no piece of the
vocabulary; so no piece can cross a cut, and the text's lattice is the product of the units' lattices.  Backward sums
over a unit's lattice, in logarithms, turn edge weights into conditional probabilities.  Segmentations get Gumbel noise from the top of the search
tree down: a node's perturbed value is the largest of all segmentations below it, the best child keeps it and the other
segmentations, as one node, get a Gumbel value truncated at it.  Opening the best open node first (A* with exact bounds)
yields distinct segmentations in order of their perturbed log-probabilities, which is sampling without replacement; the
best value left open is the threshold from which inclusion probabilities follow.  All randomness is a hash of row key,
sample, unit and step, so a row's samples depend on nothing else.
"""

from __future__ import annotations

import bisect
import itertools
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .batches import mix, pieces
from .common import table

MODEL = "/opt/tokenizers/piece_bpe_32k.model"
SAMPLES = 2
BLANK, LITERAL = 0x2581, 0x110000  # the mark of a blank, and what stands for that character in a text
#: Characters that get a column of their own in the transition table, and in the table of neighbours.
DENSE, NEAR = 160, 512
#: Characters that are worked on at once, and characters of distinct units whose lattices stay for the texts that follow.
PIECE, KEPT = 300_000, 600_000
#: Units of a text whose open values are computed first.
WIDTH = 256
GOLDEN = np.uint64(0x9E3779B97F4A7C15)
#: The key of a row without an id.
NO_ID = 0xD1B54A32D192ED03 - (1 << 64)


def vocabulary(model: str = MODEL) -> tuple[list[str], list[float], list[int]]:
    """Pieces by id, their log-probabilities and the ids of the 256 byte pieces.

    A merge table has ranks, not probabilities: a piece's weight is the reciprocal of its rank, as in Zipf's law.
    """
    import sentencepiece

    sp = sentencepiece.SentencePieceProcessor(model_file=model)
    n = sp.get_piece_size()
    rank = np.array([min(-sp.get_score(i), float(n)) + 1 for i in range(n)])
    logp = -np.log(rank) - np.log(np.sum(1 / rank))
    usable = ["" if sp.is_byte(i) or sp.is_control(i) or sp.is_unknown(i) else sp.id_to_piece(i) for i in range(n)]
    return usable, logp.tolist(), [sp.piece_to_id(f"<0x{b:02X}>") for b in range(256)]


class Codec:
    """The vocabulary as a trie in arrays."""

    def __init__(self, names: list[str], logp: list[float], byte_ids: list[int]):
        self.names, self.byte_ids = names, np.array(byte_ids)
        self.logp = np.array(logp)
        self.least = float(self.logp.min())
        count: dict[str, int] = {}
        for x in names:
            for c in x:
                count[c] = count.get(c, 0) + 1
        self.classes = np.zeros(LITERAL + 1, np.int32)
        for i, c in enumerate(sorted(count, key=lambda c: (-count[c], c))):
            self.classes[ord(c)] = i + 1
        children: list[dict[int, int]] = [{}, {}]
        terminal = [-1, -1]
        for i, x in enumerate(names):
            node = 1
            for c in x:
                k = int(self.classes[ord(c)])
                if k not in children[node]:
                    children[node][k] = len(children)
                    children.append({})
                    terminal.append(-1)
                node = children[node][k]
            if x:
                terminal[node] = i
        side_by_side = np.array(sorted({(int(self.classes[ord(a)]) << 32) + int(self.classes[ord(b)]) for x in names for a, b in zip(x, x[1:], strict=False)}), np.int64)
        self.neighbours = np.append(side_by_side, np.int64(1) << 62)
        self.near = np.zeros(NEAR * NEAR, bool)
        a, b = side_by_side >> 32, side_by_side & 0xFFFFFFFF
        both = (a < NEAR) & (b < NEAR)
        self.near[a[both] * NEAR + b[both]] = True
        self.terminal = np.array(terminal)
        self.longest = max(map(len, names))
        self.next = np.zeros((len(children), DENSE), np.int32)
        rare = []
        for a, kids in enumerate(children):
            for k, b in kids.items():
                if k < DENSE:
                    self.next[a, k] = b
                else:
                    rare.append((a * 65536 + k, b))
        rare.sort()
        self.rare_key, self.rare_to = np.array([x for x, _ in rare], np.int64), np.array([x for _, x in rare], np.int32)
        decoded = [x.replace("▁", " ").encode() for x in names]
        for b, i in enumerate(byte_ids):
            decoded[i] = bytes([b])
        self.decoded = pa.array(decoded, pa.large_binary())
        self.lattice = Lattice(self)

    def step(self, node: np.ndarray, k: np.ndarray) -> np.ndarray:
        out = self.next[node, np.minimum(k, DENSE - 1)]
        far = k >= DENSE - 1
        if far.any():
            at = np.nonzero(far)[0]
            wide = at[k[at] >= DENSE]
            out[wide] = 0
            if len(self.rare_key) and len(wide):
                key = node[wide].astype(np.int64) * 65536 + k[wide]
                i = np.minimum(np.searchsorted(self.rare_key, key), len(self.rare_key) - 1)
                out[wide] = np.where(self.rare_key[i] == key, self.rare_to[i], 0)
        return out

    def units(self, texts: list[str]) -> tuple[np.ndarray, list[bytes], np.ndarray]:
        """Numbers of all units in order, the distinct units as code points, and offsets of the texts into the numbers.

        A text, with the blank before it, is cut wherever no piece can hold the two characters at the cut.
        """
        starts = np.concatenate([[0], np.cumsum([len(t) + 1 for t in texts])]).astype(np.int64)
        codes = coded("".join([f" {t}" for t in texts]))
        cls = self.classes[codes]
        low = np.minimum(cls, NEAR - 1)
        joined = self.near[low[:-1] * NEAR + low[1:]]
        far = np.flatnonzero((low[:-1] == NEAR - 1) | (low[1:] == NEAR - 1))
        if len(far):
            key = (cls[far].astype(np.int64) << 32) + cls[far + 1]
            joined[far] = self.neighbours[np.searchsorted(self.neighbours, key)] == key
        joined[starts[1:-1] - 1] = False
        bounds = np.concatenate([[0], np.flatnonzero(~joined) + 1, [len(codes)]]) if len(codes) else np.zeros(1, np.int64)
        units = pa.Array.from_buffers(pa.large_binary(), len(bounds) - 1, [None, pa.py_buffer(bounds * codes.itemsize), pa.py_buffer(codes)]).dictionary_encode()
        ends, data = np.frombuffer(units.dictionary.buffers()[1], np.int64, len(units.dictionary) + 1).tolist(), units.dictionary.buffers()[2]
        data = data.to_pybytes() if data else b""
        return units.indices.to_numpy(), [data[i:j] for i, j in zip(ends[:-1], ends[1:], strict=True)], np.searchsorted(bounds, starts)

    def spelt(self, ids: np.ndarray, off: np.ndarray) -> tuple[memoryview, np.ndarray]:
        """The bytes that segmentations, one after the other, stand for, and the offsets of theirs."""
        found = self.decoded.take(pa.array(ids))
        at = np.frombuffer(found.buffers()[1], np.int64, len(ids) + 1)[off]
        return memoryview(found.buffers()[2] or b""), at

    def decode(self, ids: np.ndarray) -> str:
        """The text of a segmentation, without the blank that encoding puts first."""
        return bytes(self.spelt(np.asarray(ids, np.int64), np.zeros(1, int))[0]).decode("utf-8", "surrogatepass")[1:]


def coded(text: str) -> np.ndarray:
    """Code points, blanks as the vocabulary marks them."""
    codes = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.int32)
    return np.where(codes == BLANK, np.int32(LITERAL), np.where(codes == 32, np.int32(BLANK), codes))


class Lattice:
    """The lattices of the distinct units met so far, one after the other in flat arrays.

    first[s] : first[s + 1] are the edges that leave character s; long ones stand first.  An edge has a length, an id (or
    -1 - code point for a character that only bytes can spell), the log of its probability given s, and the sum of
    probabilities up to it.  A unit's numbers depend on that unit alone.
    """

    def __init__(self, codec: Codec):
        self.codec = codec
        self.place: dict[bytes, int] = {}
        self.used = {"uses": 0, "off": 1, "first": 1, "length": 0, "id": 0, "upto": 0, "logq": 0}
        self.uses, self.off, self.first = np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(1, np.int64)
        self.length, self.id, self.upto, self.logq = np.zeros(0, np.int16), np.zeros(0, np.int32), np.zeros(0), np.zeros(0)

    def _append(self, **columns: np.ndarray) -> None:
        for name, x in columns.items():
            held, n = getattr(self, name), self.used[name]
            if n + len(x) > len(held):
                held = np.concatenate([held[:n], np.empty(max(n // 8, len(x)), held.dtype)])
                setattr(self, name, held)
            held[n : n + len(x)] = x
            self.used[name] = n + len(x)

    def numbers(self, units: list[bytes]) -> np.ndarray:
        """Where the lattices of distinct units are; those of new ones are made, and rarely used ones make room for them."""
        out = list(map(self.place.get, units))
        new = [u for u, i in zip(units, out, strict=True) if i is None]
        if self.place and self.off[len(self.place)] + sum(map(len, new)) // 4 > KEPT:
            self._forget(KEPT // 2)
            out = list(map(self.place.get, units))
            new = [u for u, i in zip(units, out, strict=True) if i is None]
        if new:
            at = itertools.count(len(self.place))
            self._extend(new)
            out = [next(at) if i is None else i for i in out]
        out = np.array(out, np.int64)
        self.uses[out] += 1
        return out

    def _forget(self, chars: int) -> None:
        """Only the lattices used most often stay, of so many characters at most."""
        off = self.off[: len(self.place) + 1]
        size = np.diff(off)
        order = np.argsort(-self.uses[: len(size)], kind="stable")
        stay = np.sort(order[np.cumsum(size[order]) <= chars])
        of_chars, begin = ranges(off[stay], size[stay])
        low = self.first[off[stay]]
        edges, _ = ranges(low, self.first[off[stay + 1]] - low)
        units = list(self.place)
        self.place = {units[u]: i for i, u in enumerate(stay.tolist())}
        self.uses, self.off = self.uses[stay], np.append(begin, len(of_chars))
        self.first = np.concatenate([[0], np.cumsum(self.first[of_chars + 1] - self.first[of_chars])])
        for name in ("length", "id", "upto", "logq"):
            setattr(self, name, getattr(self, name)[edges])
        self.used = {name: len(getattr(self, name)) for name in self.used}

    def _extend(self, units: list[bytes]) -> None:
        codec, before, edges_before = self.codec, int(self.off[len(self.place)]), self.used["length"]
        n = np.array([len(u) for u in units], np.int64) // 4
        ends = np.cumsum(n)
        self.place.update(zip(units, range(len(self.place), len(self.place) + len(units)), strict=True))
        codes = np.frombuffer(b"".join(units), np.int32)
        total = len(codes)
        end = np.repeat(ends, n)
        cls = codec.classes[codes]
        found, single = [], np.zeros(total, bool)
        pos, node = np.arange(total), np.ones(total, np.int32)
        for length in range(1, codec.longest + 1):
            inside = pos + length <= end[pos]
            pos, node = pos[inside], node[inside]
            node = codec.step(node, cls[pos + length - 1])
            alive = node > 0
            pos, node = pos[alive], node[alive]
            if not len(pos):
                break
            t = codec.terminal[node]
            hit = t >= 0
            found.append((pos[hit], length, t[hit]))
            if length == 1:
                single[pos[hit]] = True
        bare = np.nonzero(~single)[0]
        found.insert(0, (bare, 1, -1 - codes[bare]))
        degree = np.zeros(total, np.int64)
        for p, _, _ in found:
            degree[p] += 1
        first = np.concatenate([[0], np.cumsum(degree)]).astype(np.int64)
        edges = int(first[-1])
        lengths, ids, weight = np.zeros(edges, np.int16), np.zeros(edges, np.int32), np.zeros(edges)
        filled = np.zeros(total, np.int64)
        for p, length, t in found:
            at = first[p + 1] - 1 - filled[p]
            filled[p] += 1
            lengths[at], ids[at] = length, t
            weight[at] = np.where(t >= 0, codec.logp[np.maximum(t, 0)], codec.least)
        start = np.repeat(np.arange(total), degree)
        beta = np.zeros(total + 1)  # logs of the sums; the end of a unit counts as 1
        to = start + lengths
        inner = to < end[start]
        left = end - np.arange(total)
        by_left = np.argsort(left, kind="stable")
        cut = np.searchsorted(left[by_left], np.arange(1, (int(left.max()) if total else 0) + 2))
        for d in range(len(cut) - 1):
            p = by_left[cut[d] : cut[d + 1]]
            deg = degree[p]
            begin = np.concatenate([[0], np.cumsum(deg)[:-1]])
            e = np.repeat(first[p] - begin, deg) + np.arange(int(deg.sum()))
            beta[p] = np.logaddexp.reduceat(weight[e] + np.where(inner[e], beta[to[e]], 0.0), begin)
        q = np.exp(weight + np.where(inner, beta[to], 0.0) - beta[start])
        upto, at = q.copy(), first[:-1][degree > 1]
        last = first[1:][degree > 1]
        while len(at):
            upto[at + 1] += upto[at]
            at, last = at[at + 2 < last] + 1, last[at + 2 < last]
        self._append(uses=np.zeros(len(n), np.int64), off=before + ends, first=edges_before + first[1:], length=lengths, id=ids, upto=upto, logq=np.log(np.minimum(q, 1.0)))

    def sample(self, unit: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """A segmentation of each of the given units: edges, their offsets by unit, and log-probabilities."""
        count = np.zeros(len(unit), np.int64)
        logp = np.zeros(len(unit))
        who, pos, end = np.arange(len(unit)), self.off[unit], self.off[unit + 1]
        steps = []
        while len(who):
            seed = seed + GOLDEN
            u = uniform(seed)
            e = self.first[pos]
            open_ = np.flatnonzero((u > self.upto[e]) & (e < self.first[pos + 1] - 1))
            if len(open_):
                v, at, last = u[open_], e[open_], self.first[pos[open_] + 1] - 1
                while len(v):
                    at += 1
                    e[open_] = at
                    more = np.flatnonzero((v > self.upto[at]) & (at < last))
                    open_, v, at, last = open_[more], v[more], at[more], last[more]
            logp[who] += self.logq[e]
            count[who] += 1
            steps.append((who, e))
            pos = pos + self.length[e]
            go = np.flatnonzero(pos < end)
            who, pos, end, seed = who[go], pos[go], end[go], seed[go]
        off = np.concatenate([[0], np.cumsum(count)])
        edges = np.empty(int(off[-1]), np.int64)
        for i, (w, e) in enumerate(steps):
            edges[off[w] + i] = e
        return edges, off, logp

    def sample_other(self, unit: int, taken: list[list[int]], seed: np.uint64) -> tuple[list[int], float]:
        """A segmentation of one unit that is none of those taken, by their conditional probabilities."""
        pos, end, out, logp = int(self.off[unit]), int(self.off[unit + 1]), [], 0.0
        first = self.first[pos : end + 1].tolist()
        begin = first[0]
        logs, length = self.logq[begin : first[-1]], self.length[begin : first[-1]].tolist()
        mass, logs = np.exp(logs).tolist(), logs.tolist()
        taken = [(x, np.exp(np.cumsum(self.logq[x][::-1])[::-1]).tolist()) for x in taken]  # with the probability of what follows
        us = uniform(seed + np.arange(1, max(len(x) for x, _ in taken) + 1, dtype=np.uint64) * GOLDEN).tolist()
        at = 0
        while at < end - pos:
            a, b = first[at] - begin, first[at + 1] - begin
            if taken:
                here = mass[a:b]
                for x, after in taken:
                    here[x[len(out)] - begin - a] -= after[len(out)]
                here = [max(x, 0.0) for x in here]
                if not any(here):  # rounding; what is left here is smaller than a double can tell
                    here = mass[a:b]
            else:
                here = mass[a:b]
            if len(out) == len(us):
                us += uniform(seed + np.arange(len(us) + 1, 2 * len(us) + 1, dtype=np.uint64) * GOLDEN).tolist()
            upto = list(itertools.accumulate(here))
            e = begin + a + min(bisect.bisect_right(upto, us[len(out)] * upto[-1]), b - a - 1)
            taken = [x for x in taken if x[0][len(out)] == e]
            out.append(e)
            logp += logs[e - begin]
            at += length[e - begin]
        return out, logp

    def ids(self, edges: np.ndarray, off: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of sequences of edges with their offsets, characters outside the vocabulary spelt in bytes."""
        ids = self.id[edges]
        odd = np.flatnonzero(ids < 0)
        if not len(odd):
            return ids, off
        codes, which = np.unique(-1 - ids[odd], return_inverse=True)
        spelt = [list(chr(BLANK if c == LITERAL else c).encode("utf-8", "surrogatepass")) for c in codes.tolist()]
        sizes = np.array([len(x) for x in spelt])
        grown = np.ones(len(ids), np.int64)
        grown[odd] = sizes[which]
        place = np.concatenate([[0], np.cumsum(grown)])
        out = np.repeat(ids, grown)
        table = np.array([x + [0] * (4 - len(x)) for x in spelt])
        for j in range(4):
            has = np.flatnonzero(sizes[which] > j)
            out[place[odd[has]] + j] = self.codec.byte_ids[table[which[has], j]]
        return out, place[off]


def uniform(x: np.ndarray) -> np.ndarray:
    """Hashes to numbers inside (0, 1)."""
    return ((mix(x) >> np.uint64(11)).astype(np.float64) + 0.5) / float(1 << 53)


def noise(u: np.ndarray) -> np.ndarray:
    """Gumbel values of numbers in (0, 1], a 1 that comes from rounding taken as the number before it."""
    return -np.log(-np.log(np.minimum(u, 1 - 2.0**-53)))


#: Gumbel values from `noise` are less.
LOUDEST = 38.0


def truncated(phi: np.ndarray, most, u: np.ndarray) -> np.ndarray:
    """Gumbel values with location phi, given that they are at most `most`; minus infinity where phi is."""
    with np.errstate(divide="ignore", invalid="ignore", over="ignore"):
        g = phi - np.log(np.exp(phi - most) - np.log(u))
    return np.where(np.isneginf(phi), -np.inf, np.minimum(g, most))


def _log_rest(logp):
    """log(1 - exp(logp)), minus infinity where logp is 0."""
    with np.errstate(divide="ignore"):
        return np.log(np.maximum(-np.expm1(np.minimum(logp, 0.0)), 0.0))


def _largest(k: int, lo: np.ndarray, hi: np.ndarray, before: np.ndarray, logp: np.ndarray, seeds) -> tuple[np.ndarray, np.ndarray]:
    """For each text, whose units not drawn before are lo to hi, the k with the largest open values, and those values.

    At unit t all segmentations are open that share the units before, of log-probability before[t], and differ there; the
    noise of their value is of seeds(text, unit).  before never rises, so no unit can follow that comes into question once
    it plus the largest noise is below what was found.  The values are those before they are truncated, in the same order;
    minus infinity where a text has fewer units that can be cut otherwise.
    """
    units, values = np.zeros((len(lo), k), np.int64), np.full((len(lo), k), -np.inf)
    todo, width = np.arange(len(lo)), WIDTH
    while len(todo):
        size = np.minimum(hi[todo] - lo[todo], width)
        flat, begin = ranges(lo[todo], size)
        phi = before[flat] + _log_rest(logp[flat])
        value = phi + noise(uniform(seeds(np.repeat(todo, size), flat)))
        some = np.flatnonzero(size)
        for j in range(k if len(flat) else 0):
            most = np.full(len(todo), -np.inf)
            most[some] = np.maximum.reduceat(value, begin[some])
            same = np.flatnonzero(value == np.repeat(most, size))
            at = np.searchsorted(same, begin[some])
            units[todo[some], j], values[todo, j] = flat[same[at]], most
            value[same[at]] = -np.inf
        end = lo[todo] + size
        more = end < hi[todo]
        more[more] = before[end[more]] + LOUDEST >= values[todo[more], k - 1]
        todo, width = todo[more], width * 4
    return units, values


def ranges(lo: np.ndarray, size: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The numbers from each lo on, so many of each, one after the other; and where those of each begin."""
    begin = np.cumsum(size) - size
    return np.arange(int(size.sum())) + np.repeat(lo - begin, size), begin


def draw(codec: Codec, texts: list[str], keys: np.ndarray, k: int = SAMPLES) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Up to k distinct segmentations of each text, one after the other: numbers of their texts, counts of units,
    log-probabilities, perturbed values, inclusion, and all ids with offsets.

    A text with fewer segmentations gets all of them, each with inclusion 1.
    """
    with np.errstate(over="ignore"):
        codes, distinct, off = codec.units(texts)
        lat = codec.lattice
        codes = lat.numbers(distinct)[codes]
        keys = mix(np.asarray(keys, np.uint64))
        n = np.diff(off)
        place = np.arange(int(n.max(initial=0)), dtype=np.uint64) * np.uint64(4)

        def seeds(text: np.ndarray, unit: np.ndarray, sample: int, what: int) -> np.ndarray:
            return mix(keys[text] ^ mix(place + (np.uint64(what) + (np.uint64(sample) << np.uint64(40))))[unit])

        bound = noise(uniform(keys ^ np.uint64(77)))
        # Of each text: samples as (edges, offsets, running log-probability, value), the largest open values of each with their units, and what was taken by sample and unit.
        drawn: list[list[tuple]] = [[] for _ in texts]
        nodes: list[list[list[list]]] = [[] for _ in texts]
        taken: list[dict] = [{} for _ in texts]
        fresh, since = np.arange(len(texts)), np.zeros(len(texts), np.int64)  # texts, and the units from which their new samples are drawn anew
        heads: list[tuple] = [(np.zeros(0, np.int64), np.zeros(1, np.int64), np.zeros(1))] * len(texts)
        for turn in range(k):
            flat, begin = ranges(off[fresh] + since, n[fresh] - since)
            text = np.repeat(fresh, n[fresh] - since)
            edges, eoff, logp = lat.sample(codes[flat], seeds(text, flat - off[text], turn, 0))
            before = np.empty(len(flat))
            ends = [*begin.tolist(), len(flat)]
            cuts = eoff[ends].tolist()
            for j, (i, head) in enumerate(zip(fresh.tolist(), heads, strict=True)):
                a, b, (kept, hoff, hrun) = ends[j], ends[j + 1], head
                run = np.concatenate([hrun, hrun[-1] + np.cumsum(logp[a:b])])
                before[a:b] = run[len(hrun) - 1 : -1]
                drawn[i].append((np.concatenate([kept, edges[cuts[j] : cuts[j + 1]]]), np.concatenate([hoff, hoff[-1] + eoff[a + 1 : b + 1] - cuts[j]]), run, float(bound[i])))
            # An open value only falls, k - 1 times in all: the largest is always among the k largest at first.
            units, values = _largest(k, begin, np.array(ends[1:], np.int64), before, logp, lambda j, at: seeds(fresh[j], flat[at] - off[fresh[j]], turn, 1))
            for r in range(k):
                real = np.flatnonzero(np.diff(ends) > r)
                at, i = units[real, r], fresh[real]
                t = flat[at] - off[i]
                phi = np.where(np.isneginf(values[real, r]), -np.inf, before[at] + _log_rest(logp[at]))
                g = truncated(phi, bound[i], uniform(seeds(i, t, turn, 1)))
                for i_, t_, g_ in zip(i.tolist(), t.tolist(), g.tolist(), strict=True):
                    if r == 0:
                        nodes[i_].append([])
                    nodes[i_][-1].append([g_, t_])
            for j in np.flatnonzero(np.diff(ends) == 0).tolist():
                nodes[fresh[j]].append([])
            if turn == k - 1:
                break
            best = []
            for i in fresh.tolist():
                s, node = max(((s, x) for s, xs in enumerate(nodes[i]) for x in xs), key=lambda y: y[1][0])
                if node[0] > -np.inf:
                    best.append((i, s, node))
            fresh, since, heads = np.array([i for i, _, _ in best], np.int64), np.array([x[1] for _, _, x in best], np.int64), []
            value = np.array([x[0] for _, _, x in best])
            left = np.empty(len(best))
            for j, ((i, s, (_, t)), seed) in enumerate(zip(best, seeds(fresh, since, turn + 1, 2), strict=True)):
                e, o, run, _ = drawn[i][s]
                done = taken[i].setdefault((s, t), [e[o[t] : o[t + 1]].tolist()])
                other, logq = lat.sample_other(int(codes[off[i] + t]), done, seed)
                done.append(other)
                mass = sum(math.exp(lat.logq[x].sum()) for x in done)
                left[j] = run[t] + (math.log1p(-mass) if mass < 1 - 1e-12 else -math.inf)
                heads.append((np.concatenate([e[: o[t]], np.array(other, np.int64)]), np.concatenate([o[: t + 1], [o[t] + len(other)]]), np.concatenate([run[: t + 1], [run[t] + logq]])))
            for (_, _, node), g in zip(best, truncated(left, value, uniform(seeds(fresh, since, turn + 1, 3))).tolist(), strict=True):
                node[0] = g
            bound[fresh] = value
            since = since + 1
        samples = [x for one in drawn for x in one]
        of = np.repeat(np.arange(len(texts)), [len(one) for one in drawn])
        kappa = np.array([max((x[0] for xs in one for x in xs), default=-np.inf) for one in nodes])[of]
        logp, value = np.array([run[-1] for _, _, run, _ in samples]), np.array([g for *_, g in samples])
        inclusion = np.where(np.isneginf(kappa), 1.0, -np.expm1(-np.exp(np.minimum(logp - kappa, 700.0))))
        ids, at = lat.ids(np.concatenate([np.zeros(0, np.int64), *(e for e, *_ in samples)]), np.concatenate([[0], np.cumsum([len(e) for e, *_ in samples])]).astype(np.int64))
        return of, n[of], logp, value, inclusion, ids, at


def segmentations(codec: Codec, texts: list[str], keys: np.ndarray, k: int = SAMPLES) -> list[list[tuple[np.ndarray, int, float, float, float]]]:
    """For each text up to k distinct segmentations as (ids, units, log-probability, perturbed value, inclusion)."""
    of, *columns, ids, at = draw(codec, texts, keys, k)
    out: list[list[tuple]] = [[] for _ in texts]
    for j, (i, *row) in enumerate(zip(of.tolist(), *(x.tolist() for x in columns), strict=True)):
        out[i].append((ids[at[j] : at[j + 1]], *row))
    return out


def ids_hash(ids: np.ndarray, off: np.ndarray) -> np.ndarray:
    """Signed 64-bit hashes of sequences of ids, none of them empty, with their offsets."""
    place = np.arange(1, len(ids) + 1) - np.repeat(off[:-1], np.diff(off))
    each = mix(ids.astype(np.uint64) + (place.astype(np.uint64) << np.uint64(20)))
    return np.add.reduceat(each, off[:-1]).astype(np.int64) if len(ids) else np.zeros(0, np.int64)


held: tuple = (None, None)


def _codec(sent) -> Codec:
    """The codec of a vocabulary; the last one stays in the process for the tasks that follow."""
    global held
    if held[0] is not sent:
        held = (sent, Codec(*sent))
    return held[1]


def sample_documents(docs: DataFrame, k: int = SAMPLES, model: str = MODEL, copy_col: str | None = None) -> DataFrame:
    """doc_id, copy, sample (from 1), n_units, n_tokens, log_prob, perturbed, inclusion, ids_hash, round_trip, ids.

    log_prob is that of the segmentation among all of its text, perturbed its Gumbel value (falling with sample),
    inclusion the probability of being among the samples given the threshold, ids the pieces, round_trip whether
    decoding them gives the text back.  A null text counts as empty, and the empty text has the one segmentation of a
    single blank.  The key of a row is its id and its number in copy_col (0 without one): rows that repeat both and the
    text get equal samples; a null id is a key of its own.  An empty table gives no rows, and other columns are ignored.
    """
    sent = docs.sparkSession.sparkContext.broadcast(vocabulary(model))
    schema = "doc_id bigint, copy int, sample int, n_units bigint, n_tokens bigint, log_prob double, perturbed double, inclusion double, ids_hash bigint, round_trip boolean, ids array<int>"

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = [x.split()[0] for x in schema.split(", ")]
        for batch, texts in pieces(batches, chars=PIECE):
            codec = _codec(sent.value)
            copies = batch.column("copy")
            with np.errstate(over="ignore"):
                keys = pc.fill_null(batch.column("doc_id"), NO_ID).to_numpy().astype(np.uint64) + GOLDEN * copies.to_numpy().astype(np.uint64)
            of, units, logp, value, inclusion, ids, off = draw(codec, texts, keys, k)
            spelt, at = codec.spelt(ids, off)
            at, nth, same = at.tolist(), -1, []
            for j, i in enumerate(of.tolist()):
                if i != nth:
                    nth, text = i, f" {texts[i]}".encode("utf-8", "surrogatepass")
                same.append(spelt[at[j] : at[j + 1]].tobytes() == text)
            rows = pa.array(of)
            nth = np.arange(1, len(of) + 1) - np.searchsorted(of, of)
            cols = [pa.array(nth, pa.int32()), *map(pa.array, (units, np.diff(off), logp, value, inclusion, ids_hash(ids, off))), pa.array(same, pa.bool_())]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(rows), copies.take(rows), *cols, pa.ListArray.from_arrays(off.astype(np.int32), ids)], names=names)

    copy = F.lit(0) if copy_col is None else F.coalesce(F.col(copy_col), F.lit(0))
    return docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"), copy.cast("int").alias("copy")).mapInArrow(run, schema)


def op5_sentencepiece_sampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two distinct sampled segmentations of every document."""
    return sample_documents(table(spark, sf_dir, "documents", "doc_id", "text"))
