"""Cross-entropy difference of two 4-gram models over the corpus's own words.

Method.  A token is a word, a single letter of a script written without spaces,
or any other single character that isn't white space; case is kept and no token
is folded or left out.  The background model counts all documents, the target
model those that the labels mark, so what is gathered grows with the corpus.  The
two are matched: one vocabulary (all distinct tokens of the corpus), the same
orders, weights and uniform part, and neither has seen the document that it
scores: a document's own counts are taken off before.  A document's score is the
mean over its tokens of the target's loss minus the background's, in nats: lower
means closer to the target.  A document that occurs twice is foretold by its copy,
so its background loss stands apart.

Every text counts as: start mark, tokens, end mark.  The count of a history is
therefore that of the n-gram that ends one place before.  The marks are counted
but not scored.

Counting and lookup are exchanges of packed messages, and nothing is broadcast or
collected.  Documents are dealt into blocks by id, n-grams into buckets by a
hash of ``BITS`` bits.  A block sends each bucket the sorted distinct hashes that
it has there, with their counts; the bucket adds the counts of all blocks and
answers each with what the others have, in its own order.  A frequent n-gram is
thus one entry per block.  The number of blocks follows from the size of the texts alone.  There are three such rounds: words and bigrams, then
3-grams, then 4-grams.  An n-gram occurs in another document only if both shorter
n-grams within it do, so a round leaves out those whose count without the
document's own is 0 anyway: the losses are the same as if every n-gram were sent.  A round reads
of the answers only whether an n-gram is in another document; the last one reads the counts.
Two n-grams of a corpus of 1e9 distinct ones share a hash with a chance of 4e-6
each; then their counts are added.

Defined results: null texts and texts of white space have no tokens and score 0;
rows that repeat an id are scored each, and a row sees the others; rows of one
hot id are dealt over ``SALTS`` blocks by their texts; with no target document
every difference is 0; very long texts are read whole; other columns are ignored,
whatever their names; an empty table gives none.
"""

from __future__ import annotations

import functools

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
import pyarrow.ipc
import regex
import zstandard
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import shuffle_partitions, table, whole_text

ORDER = 4
#: Weights of the orders 4, 3, 2, 1 and of the uniform model.
MIX = (0.55, 0.27, 0.12, 0.055, 0.005)
#: Code points of text in a block on average; there are as many buckets as blocks, so neither grows with the corpus.
BLOCK_CHARS = 8_000_000
SALTS = 16
PIECE = 48 << 20
#: Tokens hashed at a time: what is made of them stays in a core's cache.
CACHED = 1 << 14
BITS = 48
_UNSPACED = r"\p{Han}\p{Hiragana}\p{Katakana}\p{Thai}\p{Lao}\p{Khmer}\p{Myanmar}"
_WORD = rf"(?V1)[[\p{{L}}\p{{M}}\p{{N}}_]--[{_UNSPACED}]]+"
_SINGLE = rf"(?V1)[\S--[[\p{{L}}\p{{M}}\p{{N}}_]--[{_UNSPACED}]]]+"
_U = np.uint64
_DROP = _U(64 - BITS)
_START, _END = _U(0x9E3779B97F4A7C15), _U(0xC2B2AE3D27D4EB4F)
_ODD = [_U(x) for x in (0xBF58476D1CE4E5B9, 0x94D049BB133111EB, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F)]
MESSAGE = "block int, bucket int, body binary"


# --- packed arrays -----------------------------------------------------------


_zip = functools.cache(lambda: zstandard.ZstdCompressor(level=1, write_checksum=False))
_unzip = functools.cache(zstandard.ZstdDecompressor)


def pack(*arrays: np.ndarray) -> bytes:
    """Arrays of unsigned numbers by planes of their bytes; empty planes are left out, the two highest compressed each for itself."""
    heads, bodies = [], []
    for a in arrays:
        planes = int(a.max()).bit_length() + 7 >> 3 if len(a) else 0
        heads += [len(a), planes]
        for i in range(planes):
            plane = (a >> a.dtype.type(8 * i) if i else a).astype(np.uint8).tobytes()
            short = _zip().compress(plane) if len(plane) > 64 and i >= planes - 2 else plane  # lower ones are noise
            bodies.append(short if len(short) < len(plane) else plane)
            heads.append(len(bodies[-1]))
    return np.array(heads, np.uint32).tobytes() + b"".join(bodies)


def unpack(body: bytes, n: int, wanted: tuple[int, ...] | None = None) -> list[np.ndarray]:
    """The wanted ones (or all) of the ``n`` arrays of a packed body."""
    heads, shapes, at = np.frombuffer(body, np.uint32, len(body) // 4), [], 0
    for _ in range(n):
        size, planes = heads[at : at + 2].tolist()
        shapes.append((size, heads[at + 2 : at + 2 + planes].tolist()))
        at += 2 + planes
    at *= 4
    out = []
    for k, (size, shares) in enumerate(shapes):
        if wanted is not None and k not in wanted:
            at += sum(shares)
            continue
        number = np.zeros(size, np.uint64)
        for i, share in enumerate(shares):
            plane = body[at : at + share]
            plane = np.frombuffer(plane if share == size else _unzip().decompress(plane), np.uint8)
            number = number | (plane.astype(np.uint64) << _U(8 * i)) if i else plane.astype(np.uint64)
            at += share
        out.append(number)
    return out


# --- tokens and n-grams of a block -------------------------------------------


@functools.lru_cache(None)
def _classes() -> np.ndarray:
    """Of every code point: 0 white space, 1 part of a word, 2 a token of its own."""
    points = np.r_[0:0xD800, 0xE000:0x110000].astype(np.uint32)
    every = points.tobytes().decode("utf-32-le")
    out = np.zeros(0x110000, np.uint8)
    out[0xD800:0xE000] = 2
    for kind, pattern in ((1, _WORD), (2, _SINGLE)):
        for m in regex.finditer(pattern, every):
            out[points[m.start() : m.end()]] = kind
    return out


@functools.lru_cache(None)
def _byte_classes() -> bytes:
    """The same of every byte below 128."""
    return _classes()[:128].tobytes() + bytes(128)


def _pieces(n: int):
    return (slice(lo, min(lo + CACHED, n)) for lo in range(0, n, CACHED))


def _mix_own(x: np.ndarray) -> np.ndarray:
    """Every number mixed, in the array's own place."""
    for shift, odd in ((30, _ODD[0]), (27, _ODD[1])):
        x ^= x >> _U(shift)
        x *= odd
    x ^= x >> _U(31)
    return x


def _kinds(data: bytes, byte: np.ndarray) -> np.ndarray:
    """The class of the character of every byte of UTF-8; 3 for the further bytes of a token of its own."""
    kind = np.frombuffer(bytearray(data.translate(_byte_classes())), np.uint8)
    lead = np.flatnonzero(byte >= 0xC0)
    if len(lead):
        head = byte[lead].astype(np.uint32)
        size = 2 + (head >= 0xE0).astype(np.int64) + (head >= 0xF0)
        point = head & (0xFF >> (size + 1)).astype(np.uint32)
        for i in (1, 2, 3):
            more = slice(None) if i == 1 else np.flatnonzero(size > i)
            point[more] = point[more] << np.uint32(6) | (byte[lead[more] + i] & np.uint32(63))
        here = _classes()[point]
        kind[lead] = here
        here = np.where(here == 2, np.uint8(3), here)
        for i in (1, 2, 3):
            more = slice(None) if i == 1 else np.flatnonzero(size > i)
            kind[lead[more] + i] = here[more]
    return kind


def tokens(texts: list[str]) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of the tokens of all texts, one after another, and how many each has."""
    coded = [t.encode("utf-8", "surrogatepass") for t in texts]
    data = b"\n".join(coded) + b"\n" * 17  # so that the last token can be read in whole numbers
    byte = np.frombuffer(data, np.uint8)
    kind = _kinds(data, byte)
    word, single = kind == 1, kind == 2
    edge = word.copy()
    edge[1:] &= ~word[:-1]
    starts = np.flatnonzero(edge | single)
    np.copyto(edge, word)
    edge[:-1] &= ~word[1:]
    single |= kind == 3
    single[:-1] &= kind[1:] != 3
    sizes = np.flatnonzero(edge | single) + 1 - starts
    whole = np.frombuffer(data, "<u8", len(data) >> 3)

    def eight(at: np.ndarray, size: np.ndarray) -> np.ndarray:
        """The first bytes, at most 8 and as many as there are, from a place on."""
        at, low = at >> 3, (at << 3).astype(_U) & _U(63)
        out = whole[at] >> low
        out |= (whole[at + 1] << _U(1)) << (_U(63) - low)
        out <<= _U(64) - (np.minimum(size, 8) << 3).astype(_U)
        return out

    value = np.empty(len(starts), _U)
    for at in _pieces(len(starts)):
        value[at] = _mix_own(eight(starts[at], sizes[at]))
    long = np.flatnonzero(sizes > 8)
    if len(long):  # a number for every 8 bytes at their place in the token: no pattern of characters cancels out
        more = (sizes[long] - 1) >> 3
        begin = np.cumsum(more) - more
        owner = np.repeat(np.arange(len(long)), more)
        part = np.empty(len(owner), _U)
        for at in _pieces(len(owner)):
            own = owner[at]
            step = np.arange(at.start + 1, at.stop + 1) - begin[own]
            token = long[own]
            part[at] = _mix_own(eight(starts[token] + (step << 3), sizes[token] - (step << 3)))
            part[at] += step.astype(_U) * _ODD[3]
            _mix_own(part[at])
        value[long] += np.add.reduceat(part, begin)
    for at in _pieces(len(starts)):
        value[at] += sizes[at].astype(_U) * _ODD[2]
        _mix_own(value[at])
    return value, np.diff(np.searchsorted(starts, np.cumsum([len(t) + 1 for t in coded])), prepend=0)


def in_order(hashes: np.ndarray, buckets: int = 1) -> tuple[np.ndarray, np.ndarray]:
    """The sorted hashes and their places, those of equal ones rising.

    Numbers alone are sorted several times faster than places by numbers, so a place
    takes the last bits of its hash.  Where unlike hashes differ in those only, the
    result isn't sorted, and the plain way is taken.  Hashes less their bucket's least
    one leave more bits free.
    """
    low = _U((1 << max(len(hashes) - 1, 0).bit_length()) - 1)
    key = hashes << (_DROP + _U(buckets.bit_length() - 1))
    key &= ~low
    key |= np.arange(len(hashes), dtype=_U)
    key.sort()
    key &= low
    order = key.view(np.int64)
    s = hashes[order]
    if (s[1:] < s[:-1]).any():
        order = np.argsort(hashes, kind="stable")
        s = hashes[order]
    return s, order


def _firsts(s: np.ndarray) -> np.ndarray:
    """Where a number of a sorted array stands first."""
    new = np.ones(len(s), bool)
    np.not_equal(s[1:], s[:-1], out=new[1:])
    return np.flatnonzero(new)


class Counts:
    """The distinct ones of some n-grams, how often each is there, and how often in the target's documents."""

    def __init__(self, hashes: np.ndarray, good: np.ndarray):
        s = hashes << _U(1)
        s |= good
        s.sort()
        before = np.zeros(len(s) + 1, np.int64)
        np.cumsum((s & _U(1)).astype(np.uint8), out=before[1:])
        s >>= _U(1)
        begin = np.append(_firsts(s), len(s))
        self.known = s[begin[:-1]]
        self.all = np.diff(begin)
        self.good = np.diff(before[begin])


class Places:
    """The places of some n-grams in the order of these, so that those of one n-gram, and of one text there, are neighbours."""

    def __init__(self, hashes: np.ndarray, text: np.ndarray):
        s, self.order = in_order(hashes)  # equal ones stay in the order of the texts
        self.begin = _firsts(s)
        self.all = np.diff(self.begin, append=len(s))
        self.text = text

    def shared(self, others: np.ndarray) -> np.ndarray:
        """Of every place, whether its n-gram is in another document, by its counts in the other blocks."""
        out = np.empty(len(self.order), bool)
        if len(out):
            last = self.begin + self.all - 1
            found = (others > 0) | (self.text[self.order[self.begin]] != self.text[self.order[last]])
            out[self.order] = np.repeat(found, self.all)
        return out

    def others(self, elsewhere: list[np.ndarray], is_good: np.ndarray) -> list[np.ndarray]:
        """Of every place, the n-gram's counts in the other documents and in the target's other documents."""
        text = self.text[self.order]
        first = np.zeros(len(text), bool)
        first[self.begin] = True
        first[1:] |= text[1:] != text[:-1]
        run = np.flatnonzero(first)  # an n-gram in a text
        size = np.diff(run, append=len(text))
        runs = np.cumsum(first, dtype=np.int32)[self.begin] - 1
        of = np.diff(runs, append=len(run))
        out = []
        for counts, own in zip(elsewhere, (size, np.where(is_good[text[run]], size, 0))):
            here = counts.astype(np.int64)
            if len(run):
                here += np.add.reduceat(own, runs)
            # half as wide where it can be: less of a core's cache
            full = np.empty(len(text), np.int32 if here.max(initial=0) < 1 << 31 else np.int64)
            full[self.order] = np.repeat((np.repeat(here, of) - own).astype(full.dtype), size)
            out.append(full)
        return out


class Block:
    """The n-grams of up to ``order`` tokens that end at every place of the texts of a block."""

    def __init__(self, texts: list[str], good: np.ndarray, order: int):
        value, self.sizes = tokens(texts)
        spans = np.where(self.sizes > 0, self.sizes + 2, 0)  # a text without tokens has no marks either
        ends = np.cumsum(spans)
        self.begin = (ends - spans)[spans > 0]
        self.text = np.repeat(np.arange(len(texts), dtype=np.int32), spans)
        self.is_good = good
        self.scored = np.ones(len(self.text), bool)
        self.scored[self.begin] = False
        self.scored[ends[spans > 0] - 1] = False
        token = np.full(len(self.text), _END)
        token[self.begin] = _START
        token[self.scored] = value
        self.hashes = [np.empty(len(token), _U) for _ in range(order)]
        for at in _pieces(len(token)):
            gram = token[at].copy()
            self.hashes[0][at] = gram >> _DROP
            for k in range(1, order):
                lo, hi = np.searchsorted(self.begin, (at.start - k + 1, at.stop))
                before = np.full(len(gram), _START)
                before[max(k - at.start, 0) :] = token[max(at.start - k, 0) : max(at.stop - k, 0)]
                for i in range(k):  # before the start are more start marks
                    mark = self.begin[lo:hi] + (i - at.start)
                    before[mark[(mark >= 0) & (mark < len(gram))]] = _START
                gram *= _ODD[2]
                gram += before
                _mix_own(gram)
                self.hashes[k][at] = gram >> _DROP

    def counts(self, k: int, at: np.ndarray | slice = slice(None)) -> Counts:
        """Of the n-grams of order k + 1 that end at the given places."""
        return Counts(self.hashes[k][at], self.is_good[self.text[at]])

    def places(self, k: int, at: np.ndarray | slice = slice(None)) -> Places:
        return Places(self.hashes[k][at], self.text[at])

    def possible(self, shared: np.ndarray) -> np.ndarray:
        """Places of the next order whose both shorter n-grams are in other documents, too."""
        before = np.roll(shared, 1)
        before[self.begin] = True  # before its start a text has start marks alone, which say nothing
        return np.flatnonzero(shared & before)

    def mean_losses(self, others: list[np.ndarray], total: np.ndarray, vocabulary: int) -> np.ndarray:
        """The mean loss (nats) of every text's tokens, by each place's counts in the other documents."""
        loss = np.zeros(len(self.text))
        for at in _pieces(len(loss) - 1):
            here = slice(at.start + 1, at.stop + 1)  # the first place is a start mark
            chance = np.full(at.stop - at.start, MIX[-1] / vocabulary)
            for k, weight in zip(range(ORDER, 0, -1), MIX):
                seen = others[k - 2][at] if k > 1 else total[self.text[here]]
                part = others[k - 1][here] / np.maximum(seen, 1)
                part[seen <= 0] = 1 / vocabulary
                part *= weight
                chance += part
            loss[here] = np.log(chance)
        loss[~self.scored] = 0
        sums = np.zeros(len(self.sizes))
        sums[self.sizes > 0] = -np.add.reduceat(loss, self.begin)
        return sums / np.maximum(self.sizes, 1)


# --- the exchanges -----------------------------------------------------------


def _cuts(buckets: int) -> np.ndarray:
    """Where each bucket, one of equal ranges of the hashes, begins."""
    return np.array([(i << BITS) // buckets for i in range(buckets)], np.uint64)


def _block(rows: pd.DataFrame, order: int) -> tuple[Block, pd.Series]:
    """The texts of a block in an order of their own, so that every round sees the same, and their ids."""
    parts = pa.concat_tables([pa.ipc.open_stream(b).read_all() for b in rows["body"]])
    marks = parts.filter(pc.field("is_mark"))["id"]
    docs = parts.filter(~pc.field("is_mark")).sort_by([("id", "ascending"), ("text", "ascending")])
    good = pc.is_in(docs["id"], value_set=marks.combine_chunks()).to_numpy()
    return Block(docs["text"].to_pylist(), good, order), docs["id"].to_pandas()


def _messages(block: int, buckets: int, tables: list[Counts]) -> pd.DataFrame:
    """One message per bucket with its share of each table: steps between hashes, counts in all and in the target's documents."""
    floors = _cuts(buckets)
    shares = []
    for g in tables:
        cut = np.append(np.searchsorted(g.known, floors), len(g.known))
        steps = np.diff(g.known, prepend=_U(0))
        some = cut[1:] > cut[:-1]
        steps[cut[:-1][some]] = g.known[cut[:-1][some]] - floors[some]
        shares.append((cut.tolist(), (steps, g.all.astype(_U), g.good.astype(_U))))
    bodies = [pack(*(a[cut[i] : cut[i + 1]] for cut, arrays in shares for a in arrays)) for i in range(buckets)]
    return pd.DataFrame({"block": block, "bucket": np.arange(buckets), "body": bodies})


def _add(tables: int, buckets: int):
    """Answers with what the other blocks have; the first table's totals lead."""

    def add(key: tuple, messages: pd.DataFrame) -> pd.DataFrame:
        parts = [unpack(b, 3 * tables) for b in messages["body"]]
        totals, answers = np.zeros(3, np.uint64), []
        for t in range(tables):
            ends = np.cumsum([len(p[3 * t]) for p in parts])
            hashes = np.concatenate([np.cumsum(p[3 * t], dtype=_U) for p in parts])
            s, order = in_order(hashes, buckets)
            begin = _firsts(s)
            size = np.diff(begin, append=len(s))
            real = s[begin] + _cuts(buckets)[key[0]] != _START >> _DROP
            if t == 0:
                totals[0] = real.sum()
            for c in (1, 2):
                own = np.concatenate([p[3 * t + c] for p in parts])
                total = np.add.reduceat(own[order], begin) if len(s) else own
                if t == 0:
                    totals[c] = total[real].sum()
                own[order] = np.repeat(total, size) - own[order]
                answers.append(np.split(own, ends[:-1]))
        return pd.DataFrame({"block": messages["block"], "bucket": messages["bucket"], "body": [pack(totals, *a) for a in zip(*answers)]})

    return add


def _answer(answers: pd.DataFrame, r: int, n: int, *wanted: int) -> list[list[np.ndarray]]:
    """Some of the ``n`` arrays of a round's answers, bucket by bucket."""
    found = answers[answers["round"] == r].sort_values("bucket")["body"]
    return [list(a) for a in zip(*(unpack(b, n, wanted) for b in found))]


def _send_short(buckets: int):
    def send(key: tuple, rows: pd.DataFrame) -> pd.DataFrame:
        block, _ = _block(rows, 2)
        if not len(block.text):
            return _NOTHING
        return _messages(key[0], buckets, [block.counts(0), block.counts(1)])

    return send


def _send_long(buckets: int, order: int):
    """The n-grams of an order (3 or 4) at the places where they may be in other documents."""

    def send(key: tuple, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
        block, _ = _block(rows, order)
        if not len(block.text):
            return _NOTHING
        at = None
        for r in range(1, order - 1):
            shared = np.zeros(len(block.text), bool)  # what wasn't sent is in no other document
            here = slice(None) if at is None else at
            shared[here] = block.places(r, here).shared(np.concatenate(_answer(answers, r, 5, 3)[0] if r == 1 else _answer(answers, r, 3, 1)[0]))
            at = block.possible(shared)
        return _messages(key[0], buckets, [block.counts(order - 1, at)])

    return send


_NOTHING = pd.DataFrame({"block": [], "bucket": [], "body": []})


def _score(key: tuple, rows: pd.DataFrame, answers: pd.DataFrame) -> pd.DataFrame:
    block, ids = _block(rows, ORDER)
    background = target = np.zeros(len(ids))
    if len(block.text):
        totals, *short = _answer(answers, 1, 5, 0, 1, 2, 3, 4)
        vocabulary, total, total_good = np.sum(totals, axis=0).tolist()
        others, at = [], slice(None)  # counts of each order at every place, by model
        for k in range(ORDER):
            if k > 1:
                at = block.possible(others[-1][0] > 0)
            counts = short[2 * k : 2 * k + 2] if k < 2 else _answer(answers, k, 3, 1, 2)
            found = block.places(k, at).others([np.concatenate(c) for c in counts], block.is_good)
            if k > 1:
                full = [np.zeros(len(block.text), f.dtype) for f in found]  # what wasn't sent is in no other document
                for f, counts in zip(full, found):
                    f[at] = counts
                found = full
            others.append(found)
        own = np.where(block.sizes > 0, block.sizes + 1.0, 0)
        background = block.mean_losses([a for a, _ in others], total - own, vocabulary)
        target = background
        if total_good:
            target = block.mean_losses([g for _, g in others], total_good - np.where(block.is_good, own, 0), vocabulary)
    return pd.DataFrame({"id": ids, "n_symbols": block.sizes, "target_loss": target, "background_loss": background, "score": target - background})


def _packed(batches):
    """Rows of a block as one compressed body, from as many rows as fit in PIECE bytes."""
    held, size = [], 0
    options = pa.ipc.IpcWriteOptions(compression=pa.Codec("zstd", compression_level=3))  # kept and read by every round

    def flush():
        rows = pa.Table.from_batches(held).sort_by("block")
        block = rows["block"].to_numpy()
        begin = np.flatnonzero(np.r_[True, block[1:] != block[:-1]])
        bodies = []
        for a, b in zip(begin, np.r_[begin[1:], len(block)]):
            sink, part = pa.BufferOutputStream(), rows.slice(a, b - a).drop_columns(["block"])
            with pa.ipc.new_stream(sink, part.schema, options=options) as out:
                out.write_table(part.combine_chunks())
            bodies.append(sink.getvalue().to_pybytes())
        return pa.RecordBatch.from_arrays([pa.array(block[begin], pa.int32()), pa.array(bodies, pa.binary())], ["block", "body"])

    for batch in batches:
        held.append(batch)
        size += batch.nbytes
        if size >= PIECE:
            yield flush()
            held, size = [], 0
    if sum(b.num_rows for b in held):
        yield flush()


def _dealt(docs: DataFrame, target_ids: DataFrame, id_col: str, text_col: str, blocks: int) -> DataFrame:
    """Documents and target marks by block: block, body.  A mark goes to every block that its id may be in."""
    kind = docs.schema[id_col].dataType
    block = lambda salt: F.pmod(F.xxhash64("id", salt), F.lit(blocks)).cast("int").alias("block")
    rows = docs.select(F.col(id_col).cast("string").alias("id"), whole_text(text_col).alias("text"))
    rows = rows.select(block(F.pmod(F.xxhash64("text"), F.lit(SALTS)).cast("int")), "id", F.lit(False).alias("is_mark"), "text")
    marks = target_ids.select(F.col("doc_id").cast(kind).cast("string").alias("id")).filter("id is not null")
    marks = marks.withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    marks = marks.select(block(F.col("salt")), "id", F.lit(True).alias("is_mark"), F.lit("").alias("text"))
    return rows.unionByName(marks).mapInArrow(_packed, "block int, body binary")


def score_documents(docs: DataFrame, target_ids: DataFrame, id_col: str = "doc_id", text_col: str = "text", parts: int | None = None) -> DataFrame:
    """doc_id, n_symbols (tokens), target_loss, background_loss, score for every document."""
    spark = docs.sparkSession
    if parts is None:
        chars = docs.agg(F.sum(F.length(text_col))).first()[0] or 0
        parts = 1 + chars // BLOCK_CHARS
    by_block = lambda df: df.repartition(shuffle_partitions(spark), "block")  # noqa: E731  one exchange, used by every round
    rows = by_block(_dealt(docs, target_ids, id_col, text_col, parts)).groupBy("block")
    answers = None
    for r in range(1, ORDER):
        sent = rows.applyInPandas(_send_short(parts), MESSAGE) if r == 1 else rows.cogroup(answers.groupBy("block")).applyInPandas(_send_long(parts, r + 1), MESSAGE)
        answer = by_block(sent.groupBy("bucket").applyInPandas(_add(2 if r == 1 else 1, parts), MESSAGE)).withColumn("round", F.lit(r))
        answers = answer if answers is None else answers.unionByName(answer)
    scored = rows.cogroup(answers.groupBy("block")).applyInPandas(_score, "id string, n_symbols long, target_loss double, background_loss double, score double")
    return scored.select(F.col("id").cast(docs.schema[id_col].dataType).alias("doc_id"), "n_symbols", "target_loss", "background_loss", "score")


def op9_lm_scoring(spark, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    good = table(spark, sf_dir, "labels").filter("quality = 1").select("doc_id")
    return score_documents(docs, good)
