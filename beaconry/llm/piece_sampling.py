"""SentencePiece segmentations sampled without replacement, and their decoding."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute  # noqa: F401  (pa.compute)
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from beaconry.llm.common import packed, quoted, unpacked
from beaconry.llm.textbytes import Powers, chunked, mixed, spans_hash

SPACE = "▁"
MARK = np.frombuffer(SPACE.encode(), np.uint8)
#: bytes of text whose lattices are held at once
PART = 1 << 19
#: endings that are kept from part to part of a task
MOST_NODES = 1_200_000
#: the largest Gumbel number of a 53-bit chance is 36.7; log probabilities below the start where keys are left out at first
MOST_NOISE, FAR_DOWN = 37.0, 45.0
STEP, UNIT, ROUND = (np.uint64(x) for x in (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9))


@dataclass
class Pieces:
    """The inventory of a model: the bytes of its pieces, their log weights, and the ids of single bytes."""

    parts: list[bytes]
    weight: np.ndarray
    of_byte: np.ndarray
    unknown: int

    def __post_init__(self):
        self.normal = np.array([n for n, p in enumerate(self.parts) if p and n not in set(self.of_byte.tolist())])
        sizes = np.array([len(self.parts[n]) for n in self.normal])
        joined = np.frombuffer(b"".join(self.parts[n] for n in self.normal), np.uint8).astype(np.uint64)
        stops = np.cumsum(sizes)
        code = spans_hash(joined, stops - sizes, stops)
        order = np.argsort(code)
        self.code, self.id = code[order], self.normal[order]
        self.sizes = np.unique(sizes)
        slot = self.code >> np.uint64(44)
        self.slot = np.full(1 << 20, -1, np.int32)
        self.slot[slot] = np.arange(len(slot))
        self.crowded = self.slot[slot] != np.arange(len(slot))
        # the size of the longest piece that begins with four bytes, by a hash of them
        self.longest = np.full(1 << 16, 3, np.int64)
        long = self.normal[sizes >= 4]
        lead = np.array([int.from_bytes(self.parts[n][:4], "little") for n in long], np.uint64)
        np.maximum.at(self.longest, self.lead_slot(lead), sizes[sizes >= 4])
        # what decoding writes, spaces for marks
        raw = [p.replace(SPACE.encode(), b" ") for p in self.parts]
        for byte, n in enumerate(self.of_byte.tolist()):
            if n >= 0:
                raw[n] = bytes([byte])
        self.raw = np.frombuffer(b"".join(raw), np.uint8)
        self.raw_size = np.array([len(r) for r in raw], np.int64)
        self.raw_begin = np.cumsum(self.raw_size) - self.raw_size

    @staticmethod
    def lead_slot(lead: np.ndarray) -> np.ndarray:
        return ((lead * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(48)).astype(np.int64)

    def find(self, code: np.ndarray) -> np.ndarray:
        """Ids of the pieces with these hashes, -1 where there is none."""
        at = self.slot[code >> np.uint64(44)]
        hit = np.flatnonzero(at >= 0)
        out = np.full(len(code), -1, np.int32)
        place = at[hit]
        same = self.code[place] == code[hit]
        out[hit[same]] = self.id[place[same]]
        if self.crowded.any():
            rest = hit[~same]
            place = np.minimum(np.searchsorted(self.code, code[rest]), len(self.code) - 1)
            same = self.code[place] == code[rest]
            out[rest[same]] = self.id[place[same]]
        return out


def load_pieces(path: str, smoothing: float = 1.0) -> Pieces:
    """Read a SentencePiece model, on the driver.

    A BPE model scores its pieces by minus their rank; the lattice takes the logarithm of a rank law,
    ``-smoothing * ln(1 - score)``, and byte pieces come after the last rank. A unigram model's scores are
    log probabilities and are scaled only.
    """
    import sentencepiece

    model = sentencepiece.SentencePieceProcessor(model_file=path)
    count = model.get_piece_size()
    if any(SPACE in p.lstrip(SPACE) or "\n" in p[1:] + p[:-1] for p in map(model.id_to_piece, range(count))):
        raise ValueError("the model has pieces that reach beyond a word or line")
    special = {n for n in range(count) if model.is_control(n) or model.is_unknown(n) or model.is_unused(n)}
    of_byte = np.full(256, -1, np.int64)
    for n in range(count):
        if model.is_byte(n):
            of_byte[int(model.id_to_piece(n)[1:-1], 16)] = n
    # a model with byte pieces spells out unknown characters; one without has its unknown piece for them
    parts = [b"" if n in special else model.id_to_piece(n).encode() for n in range(count)]
    score = np.array([model.get_score(n) for n in range(count)])
    single = set(of_byte.tolist())
    ranked = all(float(score[n]).is_integer() and score[n] <= 0 for n in range(count) if n not in special | single)
    weight = smoothing * (-np.log1p(-np.maximum(score, -1e8)) if ranked else score)
    low = smoothing * (-np.log(count + 1.0) if ranked else float(score.min()) - 10)
    weight[of_byte[of_byte >= 0]] = low
    weight[model.unk_id()] = low
    return Pieces(parts, weight, of_byte, model.unk_id())


# ------------------------------------------------------------ lattices


class Lattices:
    """Lattices of units of text, merged by their endings. No piece reaches beyond a unit, so a text is a chain of them.

    A node is a distinct ending of a unit, whatever comes before it; node 0 is the end itself. Edges are pieces,
    longer ones first. The total of all ways from a node to the end makes every edge's probability exact, which is the
    heuristic of the search. Units met later add the endings that are new; beyond ``MOST_NODES`` all is built anew.
    """

    def __init__(self, pieces: Pieces):
        self.pieces = pieces
        # endings by their hash
        self.code, self.number = np.zeros(0, np.uint64), np.zeros(0, np.int32)
        self.total, self.first, self.size = np.zeros(1), np.zeros(1, np.int32), np.zeros(1, np.int32)
        self.id = self.source = self.target = self.fan = np.zeros(0, np.int32)
        self.log_share = self.upto = np.zeros(0)

    def known(self, code: np.ndarray) -> np.ndarray:
        """The nodes of endings given by hash, -1 for new ones."""
        if not len(self.code):
            return np.full(len(code), -1, np.int32)
        at = np.minimum(np.searchsorted(self.code, code), len(self.code) - 1)
        return np.where(self.code[at] == code, self.number[at], np.int32(-1))

    def add(self, raw: np.ndarray, size: np.ndarray) -> None:
        """Add units that are not known: ``raw`` has their bytes in a row, ``size`` their lengths."""
        if not len(raw):
            return
        pieces = self.pieces
        stop = np.cumsum(size)
        unit = np.repeat(np.arange(len(size)), size)
        left = stop[unit] - np.arange(len(raw))
        code = spans_hash(raw.astype(np.uint64), np.arange(len(raw)), stop[unit])
        # distinct endings first: sorted, they are found fast
        own, first, inverse = np.unique(code, return_index=True, return_inverse=True)
        number = self.known(own)
        fresh = np.flatnonzero(number < 0)
        number[fresh] = len(self.total) + np.arange(len(fresh), dtype=np.int32)
        node, place, own = number[inverse], first[fresh], own[fresh]
        where = np.searchsorted(self.code, own)
        self.code = np.insert(self.code, where, own)
        self.number = np.insert(self.number, where, number[fresh])
        # which node follows each byte's node after n bytes: the node n bytes on, or the end
        after = np.append(node, np.int32(0))
        sizes = np.union1d(pieces.sizes, [1, 2, 3, 4])
        sizes = sizes[sizes <= int(left.max())][::-1]
        at, found = self._matches(raw, left, place, sizes)
        row, column = np.nonzero(found >= 0)
        ids = found[row, column]
        source = node[at][row]
        length = sizes[column]
        end = at[row] + length
        target = np.where(length == left[at][row], np.int32(0), after[end])
        nodes = len(self.total) + len(own)
        total = np.concatenate((self.total, np.full(len(own), -np.inf)))
        weight = pieces.weight[ids]
        log_share = np.empty(len(row))
        new = np.flatnonzero(np.concatenate(([True], row[1:] != row[:-1]))) if len(row) else row
        heads, many = source[new], np.diff(np.append(new, len(row)))
        far = left[at[row[new]]]
        bounds = np.append(np.flatnonzero(np.concatenate(([True], far[1:] != far[:-1]))), len(new)) if len(new) else [0]
        for a, b in zip(bounds[:-1], bounds[1:]):
            low, high = int(new[a]), int(new[b]) if b < len(new) else len(row)
            value = weight[low:high] + total[target[low:high]]
            cut = new[a:b] - low
            top = np.maximum.reduceat(value, cut)
            top[top == -np.inf] = 0.0
            with np.errstate(divide="ignore"):
                whole = np.log(np.add.reduceat(np.exp(value - np.repeat(top, many[a:b])), cut)) + top
            total[heads[a:b]] = whole
            whole[whole == -np.inf] = 0.0
            log_share[low:high] = value - np.repeat(whole, many[a:b])
        share = np.exp(log_share)
        # an edge without a way to the end is no choice; a node's last choice takes whatever a chance is
        fan = np.repeat(np.add.reduceat((share > 0).astype(np.int32), new) if len(new) else many, many)
        sums = np.cumsum(share)
        upto = sums - np.repeat(np.concatenate(([0.0], sums))[new], many)
        last = np.flatnonzero(share > 0)
        upto[last[np.diff(source[last], append=-1) != 0]] = 2.0
        spot = np.zeros(nodes, np.int32)
        count = np.zeros(nodes, np.int32)
        spot[:len(self.first)], count[:len(self.size)] = self.first, self.size
        spot[heads], count[heads] = new + len(self.id), many
        self.total, self.first, self.size = total, spot, count
        for name, values in (("id", ids), ("source", source), ("target", target), ("fan", fan.astype(np.int32)),
                             ("log_share", log_share), ("upto", upto)):
            setattr(self, name, np.concatenate((getattr(self, name), values)))

    def _matches(self, raw: np.ndarray, left: np.ndarray, place: np.ndarray, sizes: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The byte positions of ``place`` that ways can pass, nearest to their unit's end first, and per piece size
        the id that stands there, or -1."""
        pieces = self.pieces
        up, down = Powers.upto(len(raw))
        sums = np.zeros(len(raw) + 1, np.uint64)
        np.cumsum((raw + np.uint64(1)) * up[:len(raw)], out=sums[1:])
        most = int(left.max())

        def near_first(at: np.ndarray) -> np.ndarray:
            far = left[at]
            return np.argsort(far.astype(np.uint16) if most < 1 << 16 else far, kind="stable")

        at = place[(raw[place] & 0xC0) != 0x80]
        at = at[near_first(at)]
        # bytes of the character that begins there
        first = raw[at]
        width = 1 + (first >= 0xC0).astype(np.int64) + (first >= 0xE0) + (first >= 0xF0)
        far = left[at]
        width = np.minimum(width, far)
        found = np.full((len(at), len(sizes)), -1, np.int32)
        alone = np.zeros(len(at), bool)
        # no piece is longer than the longest that begins like this
        lead = np.zeros(len(at), np.uint64)
        for n in range(4):
            lead |= raw[np.minimum(at + n, len(raw) - 1)].astype(np.uint64) << np.uint64(8 * n)
        limit = np.where(far >= 4, np.minimum(far, pieces.longest[pieces.lead_slot(lead)]), far)
        for c, n in enumerate(sizes.tolist()):
            rows = np.flatnonzero(limit >= n)
            if not len(rows):
                continue
            low = at[rows]
            hit = pieces.find(mixed((sums[low + n] - sums[low]) * down[low]))
            found[rows, c] = hit
            alone[rows] |= (hit >= 0) & (width[rows] == n)
        # characters that are no piece: byte by byte, or the unknown piece for the whole
        lost = np.flatnonzero(~alone)
        column = {n: c for c, n in enumerate(sizes.tolist())}
        if pieces.of_byte.min() < 0:
            for n in np.unique(width[lost]).tolist():
                own = lost[width[lost] == n]
                found[own, column[n]] = pieces.unknown
            return at, found
        found[lost, column[1]] = pieces.of_byte[raw[at[lost]]]
        # an ending that begins within a character is passed only byte by byte
        more = place[(raw[place] & 0xC0) == 0x80]
        if not len(more):
            return at, found
        tail = np.full((len(more), len(sizes)), -1, np.int32)
        tail[:, column[1]] = pieces.of_byte[raw[more]]
        at = np.concatenate((at, more))
        order = near_first(at)
        return at[order], np.concatenate((found, tail))[order]

    def draw(self, node: np.ndarray, chance: np.ndarray) -> np.ndarray:
        """An edge of each node, by its probability."""
        edge = self.first[node]
        late = np.flatnonzero(chance >= self.upto[edge])
        while len(late):
            edge[late] += 1
            late = late[chance[late] >= self.upto[edge[late]]]
        return edge

    def draw_other(self, node: int, barred: frozenset[int], chance: float) -> int:
        """An edge of one node that is not barred."""
        low = int(self.first[node])
        edges = np.array([e for e in range(low, low + int(self.size[node])) if e not in barred])
        sums = np.cumsum(np.exp(self.log_share[edges]))
        return int(edges[min(np.searchsorted(sums, chance * sums[-1], "right"), len(edges) - 1)])


def uniform(seed: np.ndarray) -> np.ndarray:
    """Numbers in (0, 1) that depend on nothing but their seeds."""
    return ((mixed(np.asarray(seed, np.uint64)) >> np.uint64(12)).astype(np.float64) + 0.5) / float(1 << 52)


def unit_bounds(raw: np.ndarray, begins: np.ndarray) -> np.ndarray:
    """Where units begin in marked texts: at each text, at the first of several marks in a row, at line feeds and
    after them."""
    mark = np.zeros(len(raw) + 3, bool)
    if len(raw) > 2:
        mark[:len(raw) - 2] = (raw[:-2] == MARK[0]) & (raw[1:-1] == MARK[1]) & (raw[2:] == MARK[2])
    start = mark[:len(raw)].copy()
    start[3:] &= ~mark[:max(0, len(raw) - 3)]
    feed = np.flatnonzero(raw == 10)
    start[feed] = True
    start[feed[feed < len(raw) - 1] + 1] = True
    start[begins[begins < len(raw)]] = True
    return np.flatnonzero(start)


# ------------------------------------------------------------ the search


def _free(lattice: Lattices, node: np.ndarray, seed: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Draw ways from nodes to the ends of their units: the edges taken, way after way, and how many each has."""
    node = node.copy()
    active = np.flatnonzero(node)
    taken, owners, step = [], [], 0
    count = np.zeros(len(node), np.int64)
    while len(active):
        edge = lattice.draw(node[active], uniform(seed[active] + np.uint64(step * int(STEP) % 2**64)))
        taken.append(edge)
        owners.append(active)
        count[active] += 1
        node[active] = onward = lattice.target[edge]
        active = active[onward != 0]
        step += 1
    offset = np.cumsum(count) - count
    out = np.empty(int(count.sum()), np.int64)
    for n, (owner, edge) in enumerate(zip(owners, taken)):
        out[offset[owner] + n] = edge
    return out, count


def _ranked(key: np.ndarray, owner: np.ndarray, by_edge: np.ndarray, room: int) -> list[list[tuple[int, int, float]]]:
    """The best keys of every text, then the second best, and so on: (text, edge, key), ``room`` times."""
    rest = key.copy()
    filled = np.flatnonzero(np.diff(by_edge))
    best = []
    for _ in range(room if len(filled) else 0):
        top = np.full(len(by_edge) - 1, np.inf)
        top[filled] = np.maximum.reduceat(rest, by_edge[:-1][filled])
        top[top == -np.inf] = np.inf
        spots = np.flatnonzero(rest == top[owner])
        spots = spots[np.unique(owner[spots], return_index=True)[1]]
        best.append(list(zip(owner[spots].tolist(), spots.tolist(), rest[spots].tolist())))
        rest[spots] = -np.inf
    return best


@dataclass
class Open:
    """A set of segmentations on the agenda: those that share the first ``kept`` edges of a way and then take none of
    the barred edges. ``key`` is the perturbed log probability of its best member, ``before`` the log probability
    of what is shared."""

    key: float
    way: np.ndarray
    counts: np.ndarray
    kept: int
    barred: frozenset[int]
    before: float


@dataclass
class Sample:
    text: int
    rank: int
    ids: np.ndarray
    log_prob: float
    key: float
    log_inclusion: float = 0.0


def _log_inclusion(log_prob: float, bound: float) -> float:
    """Log of the probability that a segmentation's key exceeds the first key that is left out."""
    if bound == -np.inf:
        return 0.0
    gap = log_prob - bound
    return gap if gap < -36 else float(np.log(-np.expm1(-np.exp(gap))))


def sample_texts(texts: list[bytes], seeds: np.ndarray, lattice: Lattices, want: int) -> list[Sample]:
    """The ``want`` segmentations of each text with the largest perturbed log probabilities.

    A best-first search over the lattice, all texts a round at a time. In a round the best set of each text's agenda
    is opened: since the lattice knows every node's total, the set's key is exact, and drawing a way through it gives
    the member that has this key. What is left of the set is split by the nodes of that way, with Gumbel keys below
    the member's. All of a text's segmentations thus have independent Gumbel keys added to their log probabilities,
    and the largest come out first, none twice. Only as many sets are kept as can still be opened, and one whose key
    bounds what is left out. Units that the lattice does not know are added to it.
    """
    marked = [MARK.tobytes() + t.replace(b" ", MARK.tobytes()) if t else b"" for t in texts]
    raw = np.frombuffer(b"".join(marked), np.uint8)
    begins = np.cumsum([0] + [len(m) for m in marked])
    starts = unit_bounds(raw, begins)
    stops = np.append(starts[1:], len(raw))[:len(starts)]
    code, first, unit = np.unique(spans_hash(raw.astype(np.uint64), starts, stops), return_index=True, return_inverse=True)
    if len(lattice.total) > MOST_NODES:
        lattice.__init__(lattice.pieces)
    first = first[lattice.known(code) < 0]
    size = stops[first] - starts[first]
    lattice.add(raw[np.repeat(starts[first] - (np.cumsum(size) - size), size) + np.arange(size.sum())], size)
    unit = lattice.known(code)[unit]
    chain = np.searchsorted(starts, begins)
    seeds = mixed(seeds.astype(np.uint64))
    agenda: list[list[Open]] = [[] for _ in texts]
    samples: list[list[Sample]] = [[] for _ in texts]
    # the first round opens the set of all segmentations
    own, opened = np.arange(len(texts)), None
    keys = -np.log(-np.log(uniform(seeds ^ ROUND)))
    branch, edge, before = np.zeros(len(texts), np.int64), np.full(len(texts), -1), np.zeros(len(texts))
    for turn in range(1, want + 1):
        room = want - turn + 1
        base = mixed(seeds[own] + np.uint64(turn * int(ROUND) % 2**64))
        # draw from the branch to the end of its unit, and through all units after it
        low = chain[own] + branch
        length = chain[own + 1] - low
        owner = np.repeat(np.arange(len(own)), length)
        by_unit = np.concatenate(([0], np.cumsum(length)))
        place = np.arange(by_unit[-1]) + np.repeat(low - by_unit[:-1], length)
        node = unit[place]
        forked = np.flatnonzero(edge >= 0)
        node[by_unit[forked]] = lattice.target[edge[forked]]
        ways, counts = _free(lattice, node, base[owner] + (place - chain[own][owner]).astype(np.uint64) * UNIT)
        by_edge = np.concatenate(([0], np.cumsum(counts)))[by_unit]
        owner = np.repeat(np.arange(len(own)), np.diff(by_edge))
        # what is left beside each edge taken, with its key
        log = lattice.log_share[ways]
        start = before.copy()
        start[forked] += lattice.log_share[edge[forked]]
        sums = np.concatenate(([0.0], np.cumsum(log)))
        base_sum = sums[by_edge[:-1]] - start
        shared = sums[:-1] - base_sum[owner]
        totals = sums[by_edge[1:]] - base_sum
        salt = mixed(base ^ STEP)
        key = np.full(len(ways), -np.inf)

        def weigh(edges: np.ndarray) -> None:
            edges = edges[lattice.fan[ways[edges]] > 1]
            whose = owner[edges]
            chance = uniform(salt[whose] + (edges - by_edge[whose]).astype(np.uint64) * UNIT)
            with np.errstate(divide="ignore"):
                free = shared[edges] + np.log(-np.expm1(log[edges])) - np.log(-np.log(chance))
            key[edges] = -np.logaddexp(-keys[whose], -free)

        # a key exceeds its set's log probability by MOST_NOISE at most, so sets far down the way need none, unless the
        # keys found before them are as low
        weigh(np.flatnonzero(shared >= start[owner] - FAR_DOWN))
        best = _ranked(key, owner, by_edge, room)
        lowest = np.full(len(own), -np.inf)
        for n, _, its_key in best[room - 1] if len(best) == room else []:
            lowest[n] = its_key
        open_end = (lowest < start - FAR_DOWN + MOST_NOISE)[owner] & (shared < start[owner] - FAR_DOWN)
        if open_end.any():
            weigh(np.flatnonzero(open_end))
            best = _ranked(key, owner, by_edge, room)
        done: list[tuple[np.ndarray, np.ndarray, int]] = []
        for n, text in enumerate(own.tolist()):
            way, count = ways[by_edge[n]:by_edge[n + 1]], counts[by_unit[n]:by_unit[n + 1]]
            skip = 0
            if edge[n] >= 0:
                from_ = opened[n]
                skip = from_.kept + 1
                way = np.concatenate((from_.way[:from_.kept], [edge[n]], way))
                whole = from_.counts[:branch[n]]
                count = count.copy()
                count[0] += skip - int(whole.sum())
                count = np.concatenate((whole, count))
                barred = from_.barred | {int(edge[n])}
                if lattice.fan[edge[n]] > len(barred):
                    rest = max(1.0 - sum(float(np.exp(lattice.log_share[e])) for e in barred), 1e-300)
                    gumbel = -np.log(-np.log(uniform(mixed(base[n:n + 1] ^ UNIT))[0]))
                    agenda[text].append(Open(float(-np.logaddexp(-keys[n], -(before[n] + np.log(rest) + gumbel))),
                                             way, count, from_.kept, barred, float(before[n])))
            done.append((way, count, skip))
            samples[text].append(Sample(text, turn, lattice.id[way], float(totals[n]), float(keys[n])))
        for n, spot, its_key in (x for ranked in best for x in ranked):
            way, count, skip = done[n]
            agenda[int(own[n])].append(Open(its_key, way, count, skip + spot - int(by_edge[n]), frozenset((int(ways[spot]),)),
                                            float(shared[spot])))
        for text in own.tolist():
            agenda[text] = sorted(agenda[text], key=lambda o: -o.key)[:room]
        own = np.array([t for t in own.tolist() if agenda[t]], np.int64) if turn < want else own[:0]
        if not len(own):
            break
        opened = [agenda[t].pop(0) for t in own.tolist()]
        keys, before = np.array([o.key for o in opened]), np.array([o.before for o in opened])
        branch = np.array([np.searchsorted(np.cumsum(o.counts), o.kept, "right") for o in opened])
        chance = uniform(mixed(seeds[own] ^ UNIT) + np.uint64((turn + 1) * int(ROUND) % 2**64))
        edge = np.array([lattice.draw_other(int(lattice.source[o.way[o.kept]]), o.barred, c) for o, c in zip(opened, chance)])
    for text, found in enumerate(samples):
        bound = agenda[text][0].key if agenda[text] else -np.inf
        for sample in found:
            sample.log_inclusion = _log_inclusion(sample.log_prob, bound)
    return [s for found in samples for s in found]


# ------------------------------------------------------------ distribution


def sample_pieces(docs: DataFrame, pieces: Pieces, key: str = "doc_id", text: str = "text", want: int = 2,
                  seed: int = 0, decoded: bool = False) -> DataFrame:
    """Rows ``(key, rank, ids, log_prob, perturbed, log_inclusion)``: up to ``want`` distinct segmentations per text.

    They are a sample without replacement from the segmentations of the whole text, with probabilities in proportion
    to the product of their pieces' weights; rank 1 has the largest perturbed log probability. ``log_inclusion`` is
    the log of the probability to be in the sample, given the first key left out; 0 if nothing is left out. Draws
    depend on the row's key and the seed alone, so a task that runs again draws the same, and rows of equal key and
    text are sampled alike (null is a key too). A text with fewer segmentations has fewer rows. A null or empty text
    has one row without pieces; an empty table gives none. Other columns are not read. With ``decoded`` the column of
    that name has the text that the ids decode to, see ``decode_pieces``, made while they are at hand.
    """
    picked = docs.select(quoted(key).alias("key"), F.xxhash64(F.lit(seed), quoted(key)).alias("seed"),
                         quoted(text).cast("binary").alias("text"))

    def of_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lattice = Lattices(pieces)
        for batch in batches:
            column, keys = batch.column("text"), batch.column("key")
            seeds = batch.column("seed").to_numpy().view(np.uint64)
            for part in chunked(pa.compute.fill_null(pa.compute.binary_length(column), 0).to_pylist(), PART):
                texts = [t or b"" for t in column.slice(part.start, part.stop - part.start).to_pylist()]
                found = sample_texts(texts, seeds[part], lattice, want)
                for rank in range(1, want + 1):
                    own = [s for s in found if s.rank == rank]
                    offsets = np.cumsum([0] + [len(s.ids) for s in own]).astype(np.int32)
                    ids = np.concatenate([s.ids for s in own] or [np.zeros(0)]).astype(np.int32)
                    arrays = [
                        keys.take(pa.array([s.text + part.start for s in own], pa.int64())),
                        pa.array(np.full(len(own), rank, np.int32)),
                        pa.ListArray.from_arrays(pa.array(offsets), pa.array(ids)),
                        *(pa.array([getattr(s, n) for s in own], pa.float64()) for n in ("log_prob", "key", "log_inclusion"))]
                    if decoded:
                        # the bytes of a text that was a string
                        arrays.append(pa.array(decode_ids(ids, offsets, pieces), pa.binary()).cast(pa.string()))
                    yield pa.RecordBatch.from_arrays(arrays, schema.names)

    schema = T.StructType([
        T.StructField("key", picked.schema["key"].dataType), T.StructField("rank", T.IntegerType()),
        T.StructField("ids", T.ArrayType(T.IntegerType())),
        *(T.StructField(n, T.DoubleType()) for n in ("log_prob", "perturbed", "log_inclusion")),
        *([T.StructField("decoded", T.StringType())] if decoded else [])])
    return picked.mapInArrow(of_batches, schema)


def decode_ids(ids: np.ndarray, offsets: np.ndarray, pieces: Pieces) -> list[bytes]:
    """Texts of id sequences: pieces with marks as spaces, byte pieces as bytes, without the space put before."""
    size = pieces.raw_size[ids]
    begin = np.cumsum(size) - size
    raw = pieces.raw[np.repeat(pieces.raw_begin[ids] - begin, size) + np.arange(size.sum())].tobytes()
    ends = np.concatenate(([0], np.cumsum(size)))[offsets].tolist()
    return [raw[a + (raw[a:a + 1] == b" "):b] for a, b in zip(ends, ends[1:])]


def decode_pieces(rows: DataFrame, pieces: Pieces, ids: str = "ids") -> DataFrame:
    """Add ``decoded``, the text of each row's ids; it takes the place of an input column of that name.

    Ids that are null or no pieces of the model count as nothing, as do control pieces; null or no ids give an empty
    text. Bytes that are no UTF-8 together become replacement characters. A text's own ``U+2581`` decodes to a space;
    everything else comes back as it was.
    """
    def of_ids(lists: pa.Array) -> pa.Array:
        out: list[str] = []
        for low in range(0, len(lists), 256):
            part = lists.slice(low, 256)
            values = part.flatten()
            number = np.asarray(values.fill_null(-1) if values.null_count else values).astype(np.int64)
            number = np.where((number >= 0) & (number < len(pieces.raw_size)), number, pieces.unknown)
            lengths = np.array([0 if n is None else n for n in pa.compute.list_value_length(part).to_pylist()], np.int64)
            out += [t.decode("utf-8", "replace") for t in decode_ids(number, np.concatenate(([0], np.cumsum(lengths))), pieces)]
        return pa.array(out, pa.string())

    decoded = F.arrow_udf(of_ids, "string")(quoted(ids).cast("array<int>"))
    return unpacked(packed(rows, decoded=decoded), rows.columns, {}, {"decoded": F.col("decoded")})
