"""N-gram Jaccard join by universe-partition pigeonhole, verified exactly.

Two documents link when the Jaccard similarity of their sets of five-word
shingles is at least 3/4.  Then the sets differ in at most ``(l + s) / 7``
tokens, l and s being their sizes.

Method
  1. Size bands.  Band k holds the sizes of the larger set of a pair; a document
     takes part in its own band and, if it may be the smaller one, in the next.
  2. Segments.  In a band, tokens are hashed into m segments.  A segment is
     indexed by its whole subset (weight 1) or also by its one-deletion
     neighbours (weight 2).  Differences use up weight, so with a total weight W
     above the bound some segment of a linked pair agrees: the pigeonhole.
     ``allocation`` picks the number of either kind per band by expected cost.
  3. Empty subsets agree between any two documents and say nothing.  Their
     weight is counted: only a document whose uninformative weight reaches W
     minus its bound emits them, as otherwise another segment has to agree.
  4. Equal keys give buckets.  A bucket first yields a star, each member with its
     smallest id, not all pairs.  Star pairs are checked by a sound bound (a
     parity sketch never shows more differences than there are) and then exactly,
     by the words of the two texts themselves.
  5. Buckets whose members are not yet connected are searched whole in blocks by
     the sketch bound; what passes is verified exactly, too.

Signatures travel in packed blobs, one per map task and partition.  Tokens are
64-bit hashes of whole shingles.  They choose candidates and count a document's own
shingles; no link rests on them: texts of equal words are known by a cryptographic
digest of the words, all other links by comparing words.

Defined results: null, empty and blank texts have no shingles and no links; with
fewer than five words the whole sequence is the one shingle; rows that repeat a
``doc_id`` are nodes of one name, so their components are joined; rows with a
null ``doc_id`` get their size and a null component; texts of any length are read
whole, one at a time; of linked documents the smallest id names the component;
other columns are ignored, whatever their names; an empty table gives none.
"""

from __future__ import annotations

import functools
import hashlib
import math

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, table, whole_text, written
from .components import connected_components

WORDS = 5
SKETCH_BITS = 1024  # at least
CHUNK_BYTES = 1 << 20
FLUSH = 1_500_000
BLOCK = 2048

_U = np.uint64
_SPACES = np.zeros(256, bool)
_SPACES[[0x20, *range(0x09, 0x0E)]] = True
_LOWER = bytes(b + 32 if 0x41 <= b <= 0x5A else b for b in range(256))
#: A random number for each byte at each of the first places of a word; later places multiply those of the place modulo their number.
_PLACES = 64
_BYTE_AT = np.random.default_rng(20240501).integers(1, 1 << 63, _PLACES * 256, dtype=np.uint64)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective 64-bit finaliser."""
    x = x ^ (x >> _U(30))
    x = x * _U(0xBF58476D1CE4E5B9)
    x = x ^ (x >> _U(27))
    x = x * _U(0x94D049BB133111EB)
    return x ^ (x >> _U(31))


def lowered(text: str) -> bytes:
    return text.encode("utf-8", "surrogatepass").translate(_LOWER)


def _word_hashes(data: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word: the sum of random numbers for its bytes at their places, so no pattern of bytes cancels out."""
    sizes = ends - starts
    first = np.cumsum(sizes) - sizes
    place = np.arange(int(sizes.sum())) - np.repeat(first, sizes)
    at = place + np.repeat(starts, sizes)
    value = _BYTE_AT[((place % _PLACES) << 8) | data[at]]
    far = np.flatnonzero(place >= _PLACES)
    if len(far):
        value[far] *= mix((place[far] // _PLACES).astype(_U)) | _U(1)
    return mix(np.add.reduceat(value, first) + sizes.astype(_U) * _U(0xD6E8FEB86659FD93))


def shingle_sets(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """Sorted distinct shingle hashes of all texts, one after another, and their counts."""
    raw = [lowered(t) for t in texts]
    data = np.frombuffer(b" " + b" ".join(raw) + b" ", np.uint8)
    n_docs = len(raw)
    space = _SPACES[data]
    starts = np.flatnonzero(space[:-1] & ~space[1:]) + 1
    ends = np.flatnonzero(~space[:-1] & space[1:]) + 1
    if not len(starts):
        return np.zeros(0, _U), np.zeros(n_docs, np.int64)
    doc_at = np.cumsum([1] + [len(r) + 1 for r in raw])[:-1]
    doc = np.searchsorted(doc_at, starts, "right") - 1
    words = _word_hashes(data, starts, ends)
    counts = np.bincount(doc, minlength=n_docs)
    step, out, owner = _U(0xA0761D6478BD642F), [], []
    if len(words) >= WORDS:
        whole = np.flatnonzero(doc[: len(doc) - WORDS + 1] == doc[WORDS - 1 :])
        h = words[whole]
        for k in range(1, WORDS):
            h = h * step + words[whole + k]
        out.append(mix(h ^ _U(WORDS)))
        owner.append(doc[whole])
    first = np.cumsum(counts) - counts
    for n in range(1, WORDS):
        few = np.flatnonzero(counts == n)
        if len(few):
            h = words[first[few]]
            for k in range(1, n):
                h = h * step + words[first[few] + k]
            out.append(mix(h ^ _U(n)))
            owner.append(few)
    hashes, owners = np.concatenate(out), np.concatenate(owner)
    if len(owner) > 1:
        order = np.argsort(owners, kind="stable")
        hashes, owners = hashes[order], owners[order]
    edges = np.flatnonzero(np.diff(owners)) + 1
    for a, b in zip(np.r_[0, edges], np.r_[edges, len(owners)]):
        hashes[a:b].sort()
    new = np.ones(len(hashes), bool)
    new[1:] = (hashes[1:] != hashes[:-1]) | (owners[1:] != owners[:-1])
    return hashes[new], np.bincount(owners[new], minlength=n_docs)


class Vocabulary:
    """Numbers for the words of a few texts; shingles become numbers by the words' own, none is hashed to fewer bits."""

    def __init__(self):
        self.known: dict[bytes, int] = {}

    def numbers(self, text: str) -> np.ndarray:
        known = self.known
        return np.array([known.setdefault(w, len(known)) for w in lowered(text).split()], np.int64)  # splits at the six characters alone

    def linked(self, x: np.ndarray, y: np.ndarray) -> bool:
        """Whether two rows of words have 100 * both >= 75 * either in distinct shingles."""
        if not len(x) or not len(y):
            return False
        k = min(WORDS, len(x), len(y))
        if min(len(x), len(y)) < WORDS and len(x) != len(y):
            return False  # a shingle of fewer words is the whole text
        keys = np.concatenate([x, y])
        base = len(self.known)
        for i in range(1, k):
            last = np.concatenate([x[i:], y[i:]])
            now = np.concatenate([keys[: len(x) - i], keys[len(x) - i + 1 : -1]])
            if int(now.max(initial=0)) >= (1 << 62) // base:
                now = np.unique(now, return_inverse=True)[1].reshape(-1)  # ranks instead: at most as many as words
            keys = now * base + last
        a, b = np.unique(keys[: len(x) - k + 1]), np.unique(keys[len(x) - k + 1 :])
        both = len(np.intersect1d(a, b, assume_unique=True))
        return 100 * both >= 75 * (len(a) + len(b) - both)


# --- bands and their allocation --------------------------------------------


@functools.lru_cache(None)
def band_edges() -> np.ndarray:
    """First sizes of the bands; a band ends before the next begins."""
    edges = [1]
    while edges[-1] < 1 << 40:
        edges.append(edges[-1] * 8 // 5 + 1)
    return np.array(edges, np.int64)


def difference_bound(size, highest):
    """Most tokens in which a linked pair can differ, for a set of this size in a band."""
    partner = np.minimum(highest, size * 4 // 3)
    return (size + partner) // 7


@functools.lru_cache(None)
def allocation(band: int) -> tuple[int, int]:
    """(segments indexed whole, segments with one-deletion neighbours) for a band.

    The cheapest by expected keys plus expected weak keys (of at most one token,
    which unrelated documents share through a common passage), among those whose
    uninformative weight stays under the limit for nearly all documents.
    """
    lowest, highest = int(band_edges()[band]), int(band_edges()[band + 1]) - 1
    most = 2 * highest // 7
    smallest = -(-3 * lowest // 4)
    sizes = sorted({smallest, lowest, math.isqrt(smallest * highest), highest})
    best = None
    for share in (0.0, 0.25, 0.5, 0.75, 1.0):
        for slack in sorted({int(most * x / 100) for x in range(0, 61, 2)} | {0, 1, 2, 3, 4}):
            weight = most + 1 + slack
            deleted = int(weight * share / 2)
            whole = weight - 2 * deleted
            m = whole + deleted
            cost, fits = 0.0, True
            for n in sizes:
                none = (1 - 1 / m) ** n
                one = n / m * (1 - 1 / m) ** (n - 1)
                two = n * (n - 1) / 2 / m / m * (1 - 1 / m) ** max(0, n - 2) if n > 1 else 0.0
                idle = whole * none + 2 * deleted * (none + one)
                room = weight - int(difference_bound(n, highest))
                fits &= idle + 2.5 * math.sqrt(idle) < room or m == 1
                cost += whole * (1 - none) + deleted * (1 + n / m) + 1.5 * (whole * one + deleted * (one + two))
            key = (not fits, cost)
            if best is None or key < best[0]:
                best = (key, (whole, deleted))
    return best[1]


def _band_keys(tokens, counts, rows, band_of) -> tuple[np.ndarray, np.ndarray]:
    """Keys of the documents ``rows`` (positions) in the bands given, with their positions."""
    first = np.cumsum(counts) - counts
    n = counts[rows]
    plan = {int(b): allocation(int(b)) for b in np.unique(band_of)}
    whole = np.array([plan[int(b)][0] for b in band_of], np.int64)
    m = whole + np.array([plan[int(b)][1] for b in band_of], np.int64)
    total = int(n.sum())
    local = np.repeat(np.arange(len(rows)), n)
    at = np.repeat(first[rows], n) + np.arange(total) - np.repeat(np.cumsum(n) - n, n)
    h = tokens[at]
    salt = mix(band_of.astype(_U) + _U(0x51ED270B))
    seg = ((mix(h ^ salt[local]) >> _U(32)) * m.astype(_U)[local] >> _U(32)).astype(np.int64)
    order = np.argsort((local << 33) | seg)
    local, seg, t = local[order], seg[order], mix(h[order] + _U(0x2545F4914F6CDD1D))
    begin = np.flatnonzero(np.r_[True, (local[1:] != local[:-1]) | (seg[1:] != seg[:-1])])
    size = np.diff(np.r_[begin, total])
    sums = np.add.reduceat(t, begin)
    g_local, g_seg = local[begin], seg[begin]
    place = mix(salt[g_local] + g_seg.astype(_U) * _U(0x9FB21C651E98DF25))

    def key(s, c, p):
        return mix(mix(s + c.astype(_U) * _U(0xC2B2AE3D27D4EB4F)) ^ p)

    deleting = g_seg >= whole[g_local]
    keys, owner = [key(sums, size, place)], [g_local]
    each = np.repeat(deleting & (size > 1), size)
    if each.any():
        g = np.repeat(np.arange(len(begin)), size)[each]
        keys.append(key(sums[g] - t[each], size[g] - 1, place[g]))
        owner.append(g_local[g])
    # weight of segments that could agree through the empty subset
    docs = len(rows)
    idle = (whole - np.bincount(g_local[~deleting], minlength=docs)) + 2 * (
        (m - whole) - np.bincount(g_local[deleting & (size > 1)], minlength=docs)
    )
    highest = band_edges()[band_of + 1] - 1
    weight = whole + 2 * (m - whole)
    for d in np.flatnonzero(idle >= weight - difference_bound(n, highest)):
        mine = g_local == d
        free = np.ones(int(m[d]), bool)
        free[g_seg[mine & ~(deleting & (size == 1))]] = False
        spots = mix(salt[d] + np.flatnonzero(free).astype(_U) * _U(0x9FB21C651E98DF25))
        keys.append(key(np.zeros(len(spots), _U), np.zeros(len(spots), np.int64), spots))
        owner.append(np.full(len(spots), d))
    return np.concatenate(keys), rows[np.concatenate(owner)]


def signatures(tokens: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """All keys of the documents in a chunk, with the documents' positions."""
    edges = band_edges()
    rows = np.flatnonzero(counts > 0)
    if not len(rows):
        return np.zeros(0, _U), np.zeros(0, np.int64)
    own = np.searchsorted(edges, counts[rows], "right") - 1
    also = 4 * counts[rows] >= 3 * edges[own + 1]
    a = _band_keys(tokens, counts, rows, own)
    if not also.any():
        return a
    b = _band_keys(tokens, counts, rows[also], own[also] + 1)
    return np.concatenate([a[0], b[0]]), np.concatenate([a[1], b[1]])


# --- passes over the documents ----------------------------------------------


def _chunks(ids, texts):
    """Slices of a batch of about CHUNK_BYTES; one long text is a chunk of its own."""
    begin, size = 0, 0
    for i, t in enumerate(texts):
        if size and size + len(t) > CHUNK_BYTES:
            yield ids[begin:i], texts[begin:i]
            begin, size = i, 0
        size += len(t)
    if begin < len(texts):
        yield ids[begin:], texts[begin:]


def _sketches(tokens, counts) -> list[bytes | None]:
    """Parity of the tokens per bit: XOR never shows more differences than the sets have.

    A sketch has at least as many bits as tokens, in a power of two, so that
    unrelated sets of any size differ in more bits than a link allows.  Half a
    sketch XOR the other half is the sketch of half as many bits.
    """
    spots = mix(tokens ^ _U(0x7F4A7C15))
    first = np.cumsum(counts) - counts
    out: list[bytes | None] = [None] * len(counts)
    for d in np.flatnonzero(counts > SKETCH_BITS).tolist():
        bits = 1 << int(counts[d] - 1).bit_length()
        at = (spots[first[d] : first[d] + counts[d]] & _U(bits - 1)).astype(np.int64)
        out[d] = np.packbits((np.bincount(at, minlength=bits) & 1).astype(np.uint8)).tobytes()
    few = np.flatnonzero((counts > 0) & (counts <= SKETCH_BITS))
    for lo in range(0, len(few), 512):
        docs = few[lo : lo + 512]
        n = counts[docs]
        at = np.repeat(first[docs] - (np.cumsum(n) - n), n) + np.arange(int(n.sum()))
        spot = (spots[at] & _U(SKETCH_BITS - 1)).astype(np.int64) + np.repeat(np.arange(len(docs)), n) * SKETCH_BITS
        bits = (np.bincount(spot, minlength=len(docs) * SKETCH_BITS) & 1).astype(np.uint8).reshape(len(docs), SKETCH_BITS)
        for d, row in zip(docs.tolist(), np.packbits(bits, axis=1)):
            out[d] = row.tobytes()
    return out


class _Sketches:
    """Sketches of many documents, each also folded to half its bits."""

    def __init__(self, column):
        column = list(column)
        self.words = np.array([len(x) // 8 for x in column], np.int64)
        self.flat = np.frombuffer(b"".join(column), _U)
        self.at = np.cumsum(self.words) - self.words
        self.half_at = self.at // 2
        self.half = np.zeros(len(self.flat) // 2 + 1, _U)
        for w in np.unique(self.words).tolist():
            rows = np.flatnonzero(self.words == w)
            whole = self.flat[self.at[rows][:, None] + np.arange(w)]
            self.half[self.half_at[rows][:, None] + np.arange(w // 2)] = whole[:, : w // 2] ^ whole[:, w // 2 :]

    def _take(self, rows, w):
        out = np.empty((len(rows), w), _U)
        even = self.words[rows] == w
        out[even] = self.flat[self.at[rows[even]][:, None] + np.arange(w)]
        out[~even] = self.half[self.half_at[rows[~even]][:, None] + np.arange(w)]
        return out

    def possible(self, i, j, n_i, n_j, other=None) -> np.ndarray:
        """Whether the sound bounds on size and differences leave pairs (i, j) possible."""
        other = other or self
        ok = (4 * n_i >= 3 * n_j) & (4 * n_j >= 3 * n_i)
        narrow = np.minimum(self.words[i], other.words[j])
        for w in np.unique(narrow[ok]).tolist():
            rows = np.flatnonzero(ok & (narrow == w))
            step = max(1, (1 << 20) // w)
            for lo in range(0, len(rows), step):
                r = rows[lo : lo + step]
                apart = np.bitwise_count(self._take(i[r], w) ^ other._take(j[r], w)).sum(axis=1)
                ok[r] = apart <= (n_i[r] + n_j[r]) // 7
        return ok


def _profile(batches):
    for pdf in batches:
        for ids, texts in _chunks(pdf["doc_id"].to_numpy(), pdf["text"].tolist()):
            tokens, counts = shingle_sets(texts)
            packed = _sketches(tokens, counts)
            yield pd.DataFrame({"doc_id": ids, "n_shingles": counts, "sketch": packed})


def _planes(a: np.ndarray) -> bytes:
    """Bytes of 64-bit numbers by plane, so equal high bytes lie together."""
    return np.ascontiguousarray(a).view(np.uint8).reshape(-1, 8).T.tobytes()


def _unplanes(b: bytes) -> np.ndarray:
    return np.ascontiguousarray(np.frombuffer(b, np.uint8).reshape(8, -1).T).view(np.int64).reshape(-1)


def _packer(parts: int):
    """Turns (values, ids) into rows (part, values, ids), one per part with rows."""

    def pack(keys, ids):
        part = ((keys >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)
        order = np.argsort(part, kind="stable")
        keys, ids, part = keys[order], ids[order], part[order]
        cut = np.flatnonzero(np.diff(part)) + 1
        rows = [(int(p[0]), k.tobytes(), _planes(i)) for p, k, i in zip(np.split(part, cut), np.split(keys, cut), np.split(ids, cut)) if len(p)]
        return pd.DataFrame(rows, columns=["part", "keys", "ids"])

    return pack


def _sign(parts: int):
    """Signature blobs of a task's distinct texts; one of words seen before gives an equal pair (part -1)."""
    pack = _packer(parts)

    def run(batches):
        seen: dict[bytes, int] = {}
        keys, ids, held = [], [], 0
        for pdf in batches:
            pdf = pdf[pdf["doc_id"].notna()]
            for names, texts in _chunks(pdf["doc_id"].to_numpy(np.int64), pdf["text"].tolist()):
                tokens, counts = shingle_sets(texts)
                keep, equal = np.zeros(len(counts), bool), []
                some = np.flatnonzero(counts)
                for d in some.tolist():
                    x = hashlib.blake2b(b" ".join(lowered(texts[d]).split()), digest_size=16).digest()
                    other = seen.setdefault(x, int(names[d]))
                    if other == names[d]:
                        keep[d] = True
                    else:
                        equal.append((other, int(names[d])))
                if equal:
                    pairs = np.array(equal, np.int64)
                    yield pd.DataFrame({"part": [-1], "keys": [_planes(pairs[:, 0])], "ids": [_planes(pairs[:, 1])]})
                k, d = signatures(tokens[np.repeat(keep, counts)], np.where(keep, counts, 0))
                keys.append(k)
                ids.append(names[d])
                held += len(k)
                if held >= FLUSH:
                    yield pack(np.concatenate(keys), np.concatenate(ids))
                    keys, ids, held = [], [], 0
        if held:
            yield pack(np.concatenate(keys), np.concatenate(ids))

    return run


def _buckets(parts: int = 4096):
    """Star pairs and, for buckets of three or more, their members, from a partition's blobs."""

    def run(batches):
        keys, ids = [], []
        for pdf in batches:
            for part, k, i in zip(pdf["part"], pdf["keys"], pdf["ids"]):
                if part < 0:
                    yield pd.DataFrame({"kind": ["equal"], "part": [0], "bucket": [0], "hub": [0], "keys": [k], "ids": [i]})
                else:
                    keys.append(np.frombuffer(k, _U))
                    ids.append(_unplanes(i))
        if not keys:
            return
        keys, ids = np.concatenate(keys), np.concatenate(ids)
        order = np.lexsort((ids, keys))
        keys, ids = keys[order], ids[order]
        new = np.r_[True, (keys[1:] != keys[:-1]) | (ids[1:] != ids[:-1])]
        keys, ids = keys[new], ids[new]
        begin = np.flatnonzero(np.r_[True, keys[1:] != keys[:-1]])
        size = np.diff(np.r_[begin, len(keys)])
        many = size > 1
        take = np.repeat(many, size)
        ids, size = ids[take], size[many]
        if not len(size):
            return
        begin = np.cumsum(size) - size
        name = mix(np.add.reduceat(mix(ids.astype(_U)), begin) + size.astype(_U))
        _, once = np.unique(name, return_index=True)
        hub = np.repeat(ids[begin], size)
        chosen = np.zeros(len(size), bool)
        chosen[once] = True
        star = np.repeat(chosen, size) & (hub != ids)
        pairs = np.unique(np.stack([hub[star], ids[star]], 1), axis=0)
        where = mix(mix(pairs[:, 0].astype(_U)) + pairs[:, 1].astype(_U))
        order = np.argsort(where)
        spots = ((where[order] >> _U(32)) * _U(parts) >> _U(32)).astype(np.int64)
        cut = np.flatnonzero(np.diff(spots)) + 1
        rows = [("pair", int(s[0]), 0, 0, _planes(p[:, 0].copy()), _planes(p[:, 1].copy())) for s, p in zip(np.split(spots, cut), np.split(pairs[order], cut)) if len(s)]
        for b in once[size[once] > 2].tolist():
            members = ids[begin[b] : begin[b] + size[b]]
            for lo in range(0, len(members), 4096):
                rows.append(("bucket", 0, int(name[b].astype(np.int64)), int(members[0]), b"", _planes(members[lo : lo + 4096])))
        for lo in range(0, len(rows), 5000):
            yield pd.DataFrame(rows[lo : lo + 5000], columns=["kind", "part", "bucket", "hub", "keys", "ids"])

    return run


def _unpack_pairs(batches):
    a, b = [], []
    for pdf in batches:
        a += [_unplanes(k) for k in pdf["keys"]]
        b += [_unplanes(i) for i in pdf["ids"]]
    if a:
        both = np.unique(np.stack([np.concatenate(a), np.concatenate(b)], 1), axis=0)
        for lo in range(0, len(both), 50_000):
            yield pd.DataFrame({"a": both[lo : lo + 50_000, 0], "b": both[lo : lo + 50_000, 1]})


def _unpack_buckets(batches):
    for pdf in batches:
        members = [_unplanes(i) for i in pdf["ids"]]
        if members:
            sizes = [len(m) for m in members]
            yield pd.DataFrame({"bucket": np.repeat(pdf["bucket"].to_numpy(), sizes), "doc_id": np.concatenate(members)})


def _filter_pairs(batches):
    for pdf in batches:
        if len(pdf):
            rows = np.arange(len(pdf))
            ok = _Sketches(pdf["sketch_a"]).possible(rows, rows, pdf["n_a"].to_numpy(), pdf["n_b"].to_numpy(), _Sketches(pdf["sketch_b"]))
            yield pdf.loc[ok, ["a", "b"]]


def _verify(batches):
    """Exact test on the words of the whole texts; those of a run of equal ``a`` are read once."""
    last, x, words = None, None, None
    for pdf in batches:
        a, b = pdf["a"].to_numpy(), pdf["b"].to_numpy()
        ok = np.zeros(len(pdf), bool)
        for i, (ta, tb) in enumerate(zip(pdf["text_a"], pdf["text_b"])):
            if last is None or last[0] != a[i] or last[1] != ta or len(words.known) > 4 * len(x) + 10_000:
                words = Vocabulary()
                last, x = (a[i], ta), words.numbers(ta)
            ok[i] = words.linked(x, words.numbers(tb))
        yield pd.DataFrame({"a": a[ok], "b": b[ok]})


def _whole_groups(batches, names, least=20_000):
    """Frames of at least so many rows, cut only between values of ``names`` they are sorted by."""
    rest = []
    for pdf in batches:
        rest.append(pdf)
        if sum(map(len, rest)) < least:
            continue
        pdf = pd.concat(rest, ignore_index=True)
        k = pdf[names].to_numpy()
        cut = np.flatnonzero((k[1:] != k[:-1]).any(axis=1)) + 1
        if len(cut):
            yield pdf.iloc[: cut[-1]]
            rest = [pdf.iloc[cut[-1] :]]
        else:
            rest = [pdf]
    if rest and sum(map(len, rest)):
        yield pd.concat(rest, ignore_index=True)


def _search_blocks(batches):
    """Pairs of different components in a pair of blocks that the sketch bound leaves possible.

    Rows are compared with those at distance 1, 2, ... in their group, all
    groups at once, so small groups cost no loop of their own.
    """
    names = ["bucket", "block_a", "block_b"]
    for g in _whole_groups(batches, names):
        ids, comp, n, side = (g[c].to_numpy() for c in ("doc_id", "component_id", "n_shingles", "block"))
        k = g[names].to_numpy()
        group = np.cumsum(np.r_[0, (k[1:] != k[:-1]).any(axis=1)])
        end = np.searchsorted(group, group, "right")
        across = (k[:, 1] != k[:, 2])
        sketches = _Sketches(g["sketch"])
        rows, found = np.arange(len(g)), []
        step = 1
        while True:
            rows = rows[rows + step < end[rows]]
            if not len(rows):
                break
            i, j = rows, rows + step
            use = (comp[i] != comp[j]) & (~across[i] | (side[i] != side[j]))
            i, j = i[use], j[use]
            if len(i):
                ok = sketches.possible(i, j, n[i], n[j])
                found.append(np.stack([ids[i[ok]], ids[j[ok]]], 1))
            step += 1
        if found:
            pairs = np.unique(np.sort(np.concatenate(found), axis=1), axis=0)
            yield pd.DataFrame({"a": pairs[:, 0], "b": pairs[:, 1]})


# --- the join ----------------------------------------------------------------


def profiles(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """doc_id, n_shingles and the parity sketch (null without shingles) of every document."""
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    return rows.mapInPandas(_profile, "doc_id long, n_shingles long, sketch binary")


def _exact_links(pairs: DataFrame, known: DataFrame, texts: DataFrame) -> DataFrame:
    """The pairs that link, by the sketch bound and then by their whole texts."""
    size = known.filter("sketch is not null")
    left = size.select(F.col("doc_id").alias("a"), F.col("n_shingles").alias("n_a"), F.col("sketch").alias("sketch_a"))
    right = size.select(F.col("doc_id").alias("b"), F.col("n_shingles").alias("n_b"), F.col("sketch").alias("sketch_b"))
    possible = pairs.join(right, "b").join(left, "a").mapInPandas(_filter_pairs, "a long, b long")
    possible = written(possible, "possible")
    t = texts.withColumnRenamed("text", "text_b").withColumnRenamed("doc_id", "b")
    s = texts.withColumnRenamed("text", "text_a").withColumnRenamed("doc_id", "a")
    return possible.join(t, "b").join(s, "a").mapInPandas(_verify, "a long, b long").distinct()


def near_links(docs: DataFrame, known: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, DataFrame]:
    """(links, components): links that connect every component, and doc_id -> component_id.

    The links are enough to connect all linked documents: of pairs inside a
    component only the ones needed are verified.
    """
    spark = docs.sparkSession
    parts = 2 * shuffle_partitions(spark)
    texts = docs.select(F.col(id_col).cast("long").alias("doc_id"), whole_text(text_col).alias("text"))
    blobs = texts.mapInPandas(_sign(parts), "part long, keys binary, ids binary")
    found = blobs.repartition(shuffle_partitions(spark), "part").mapInPandas(
        _buckets(), "kind string, part long, bucket long, hub long, keys binary, ids binary"
    )
    found = written(found, "buckets")
    equal = found.filter("kind = 'equal'").mapInPandas(_unpack_pairs, "a long, b long")
    pairs = found.filter("kind = 'pair'").repartition(shuffle_partitions(spark), "part").mapInPandas(_unpack_pairs, "a long, b long")
    pairs = written(pairs, "pairs")
    links = written(_exact_links(pairs, known, texts).union(equal), "links")
    comps = connected_components(links, "a", "b")

    # Buckets that a failed star pair may leave in pieces: search them whole.
    failed = pairs.join(links, ["a", "b"], "left_anti").select("a").distinct()
    hubs = found.filter("kind = 'bucket'").select("bucket", "ids", F.col("hub").alias("a"))
    open_rows = (
        hubs.join(failed, "a", "left_semi")
        .select("bucket", "ids")
        .mapInPandas(_unpack_buckets, "bucket long, doc_id long")
        .distinct()
        .join(comps, "doc_id", "left")
        .withColumn("component_id", F.coalesce("component_id", "doc_id"))
    )
    open_rows = written(open_rows, "open")
    mixed = open_rows.groupBy("bucket").agg(
        F.min("component_id").alias("low"), F.max("component_id").alias("high"), F.count(F.lit(1)).alias("members")
    ).filter("low < high")
    cells = (
        open_rows.join(mixed.select("bucket", "members"), "bucket")
        .join(known.filter("sketch is not null"), "doc_id")
        .withColumn("blocks", F.ceil(F.col("members") / BLOCK).cast("int"))
        .withColumn("block", F.pmod(F.xxhash64("doc_id"), F.col("blocks")).cast("int"))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        .withColumn("block_a", F.least("block", "other"))
        .withColumn("block_b", F.greatest("block", "other"))
        .select("bucket", "block_a", "block_b", "block", "doc_id", "component_id", "n_shingles", "sketch")
    )
    names = ["bucket", "block_a", "block_b"]
    more = cells.repartition(shuffle_partitions(spark), *names).sortWithinPartitions(*names).mapInPandas(_search_blocks, "a long, b long")
    more = more.distinct().join(pairs, ["a", "b"], "left_anti")
    extra = written(_exact_links(more, known, texts), "extra")
    if extra.isEmpty():
        return links, comps
    # Joining components by the further links: their ids are the nodes now.
    one = comps.select(F.col("doc_id").alias("a"), F.col("component_id").alias("ca"))
    two = comps.select(F.col("doc_id").alias("b"), F.col("component_id").alias("cb"))
    bridge = extra.join(one, "a", "left").join(two, "b", "left").select(F.coalesce("ca", "a").alias("a"), F.coalesce("cb", "b").alias("b")).distinct()
    joined = connected_components(bridge, "a", "b").withColumnRenamed("component_id", "top")
    all_nodes = comps.unionByName(
        joined.select("doc_id", F.col("doc_id").alias("component_id")).join(comps.select("doc_id"), "doc_id", "left_anti")
    )
    final = all_nodes.join(joined.withColumnRenamed("doc_id", "component_id"), "component_id", "left").select(
        "doc_id", F.coalesce("top", "component_id").alias("component_id")
    )
    return links.unionByName(extra), written(final, "joined")


def ngram_jaccard_join(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """One row per document: doc_id, n_shingles, component_id."""
    known = written(profiles(docs, id_col, text_col), "profiles")
    _, comps = near_links(docs, known, id_col, text_col)
    return known.select("doc_id", "n_shingles").join(comps, "doc_id", "left").select(
        "doc_id", "n_shingles", F.coalesce("component_id", "doc_id").alias("component_id")
    )


def keep_one_of_each(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents without those linked to one of a smaller id, as a filtering stage."""
    known = written(profiles(docs, id_col, text_col), "profiles")
    _, comps = near_links(docs, known, id_col, text_col)
    gone = comps.filter("doc_id <> component_id").select(F.col("doc_id").alias(id_col))
    return docs.join(gone.hint("shuffle_hash"), id_col, "left_anti").select(*docs.columns)


def op1_ngram_join(spark, sf_dir: str) -> DataFrame:
    return ngram_jaccard_join(table(spark, sf_dir, "documents"))
