"""Language-model scores from a log-frequency Bloom filter.

Training texts give counts of words, word pairs and triples. A count c is stored by its
level 1 + floor(log2 c): the n-gram is put into the filter once for each level up to its
own, so the level comes back from repeated membership probes. The filter is cut into segments by
hash; each has the room that its levels need, so it grows with the corpus and no n-gram is left out.

While the whole filter is bound to fit BROADCAST_BITS, it is broadcast and every text
probes it. Beyond that its segments stay where they were built and the probes go there: documents are
dealt into blocks, a block sends its distinct n-grams to the segments, and the levels come
back in the block's order. The exact word counts of ``base_score`` always take that way. Both ways give the same levels.

With count estimates c (the middle of a level) the probabilities are
p1 = (c(w) + 1) / (N + V + 1), p2 = MIX c(vw) / c(v) + (1 - MIX) p1 and p3 = MIX c(uvw) / c(uv) + (1 - MIX) p2;
where a history was never seen, the shorter one's probability stands. ``score`` adds up log10 p3.

Edge cases: a null or empty text is one end token; a null doc_id is training; repeated
rows count each time; an empty table gives no rows. Words are told apart by 64-bit hash.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved, scratch
from .words import hash_strings, mixed, slices, split_words, sums

#: A filter that may need more bits than this is not broadcast.
BROADCAST_BITS = 1 << 28
#: Bits of the filter for each stored level of an n-gram, at least, and places of a level.
BITS_A_LEVEL, PLACES = 12, 4
MIX = 0.5
#: Training tokens to a segment, text bytes to a block.
SEGMENT_TOKENS, BLOCK_BYTES = 1_000_000, 8 << 20

_END = np.uint64(0xE4D0C8F15A3B7921)
_NEXT, _LEVEL = np.uint64(0xC2B2AE3D27D4EB4F), np.uint64(0x9FB21C651E98DF25)


def tokens(texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """Offsets and word hashes; each text ends with the end token."""
    offsets, words = split_words(texts)
    n = np.diff(offsets)
    out = offsets + np.arange(len(offsets))
    items = np.full(int(out[-1]), _END, np.uint64)
    items[np.arange(len(words)) + np.repeat(np.arange(len(n)), n)] = hash_strings(words)
    return out, items


def _before(offsets: np.ndarray, items: np.ndarray, first) -> np.ndarray:
    """What stands before each item; first for the first one of a text."""
    out = np.concatenate([items[:1], items[:-1]])
    out[offsets[:-1]] = first
    return out


def ngrams(offsets: np.ndarray, items: np.ndarray) -> list[np.ndarray]:
    """Hashes of each token alone, with the one before it and with the two before it; texts follow on end tokens."""
    pairs = mixed(_before(offsets, items, _END) * _NEXT + items)
    # A triple is the pair before the token and the token.
    ends = mixed(np.array([_END], np.uint64) * _NEXT + _END)[0]
    return [mixed(items ^ _NEXT), pairs, mixed((_before(offsets, pairs, ends) ^ _LEVEL) * _NEXT + items)]


class LogBloom:
    """Segments of bits; an n-gram's hash finds its segment by the top bits, and the next 32 are its key there."""

    def __init__(self, segments: list[np.ndarray]):
        self.top = len(segments).bit_length() - 1
        sizes = np.array([8 * len(x) for x in segments], np.int64)
        self.mask, self.start = (sizes - 1).astype(np.uint64), np.cumsum(sizes) - sizes
        self.bits = np.concatenate(segments)

    def levels(self, hashes: np.ndarray) -> np.ndarray:
        return self.levels_at(*split(hashes, self.top))

    def levels_at(self, segment: np.ndarray, keys: np.ndarray) -> np.ndarray:
        """The level of each n-gram: probes go on, level by level, for those that hit all places."""
        level = np.zeros(len(keys), np.uint8)
        live = np.arange(len(keys))
        for j in range(1, 63):
            h = mixed(keys[live].astype(np.uint64) * _LEVEL + np.uint64(j))
            for k in range(PLACES):
                s = segment[live]
                at = self.start[s] + (place(h, k) & self.mask[s]).astype(np.int64)
                hit = (self.bits[at >> 3] >> (at & 7).astype(np.uint8)) & 1 > 0
                live, h = live[hit], h[hit]
            if not len(live):
                break
            level[live] = j
        return level


def split(hashes: np.ndarray, top: int) -> tuple[np.ndarray, np.ndarray]:
    segment = (hashes >> np.uint64(64 - top)).astype(np.int64) if top else np.zeros(len(hashes), np.int64)
    return segment, (hashes >> np.uint64(32 - top)).astype(np.uint32)


def place(h: np.ndarray, k: int) -> np.ndarray:
    """The k-th place for the mixed hash of a key and a level."""
    return (h & np.uint64(0xFFFFFFFF)) + np.uint64(k) * (h >> np.uint64(32) | np.uint64(1))


def segment_bits(keys: np.ndarray, counts: np.ndarray) -> np.ndarray:
    """The bits of one segment, from its different keys with their counts above 0."""
    level = np.floor(np.log2(counts)).astype(np.int64) + 1
    room = max(64, 1 << (BITS_A_LEVEL * int(level.sum()) - 1).bit_length()) if len(keys) else 64
    bits = np.zeros(room, np.uint8)
    for j in range(1, int(level.max(initial=0)) + 1):
        h = mixed(keys[level >= j].astype(np.uint64) * _LEVEL + np.uint64(j))
        for k in range(PLACES):
            bits[place(h, k) & np.uint64(room - 1)] = 1
    return np.packbits(bits, bitorder="little")


def estimate(level: np.ndarray) -> np.ndarray:
    """The middle of the counts that have the level, 0 for none."""
    return np.where(level > 0, 1.5 * np.exp2(level.astype(np.float64) - 1) - 0.5, 0.0)


def pack_counts(counts: np.ndarray) -> bytes:
    """A byte for each count; those from 255 on follow in whole."""
    return np.minimum(counts, 255).astype(np.uint8).tobytes() + counts[counts >= 255].astype("<i8").tobytes()


def unpack_counts(data: bytes, n: int) -> np.ndarray:
    counts = np.frombuffer(data, np.uint8, n).astype(np.int64)
    counts[counts == 255] = np.frombuffer(data, "<i8", -1, n)
    return counts


def _column(batch, name: str) -> pa.Array:
    return batch.column(batch.schema.get_field_index(name))


def _read_block(block: pa.Table) -> tuple[list[pa.RecordBatch], list[np.ndarray], list[np.ndarray]]:
    batches = list(slices(iter(block.combine_chunks().to_batches())))
    pairs = [tokens(_column(b, "text")) for b in batches]
    return batches, [o for o, _ in pairs], [w for _, w in pairs]


def _numbered(parts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """The different numbers in ascending order, and the place of each number among them."""
    flat = np.concatenate(parts) if parts else np.zeros(0, np.uint64)
    return np.unique(flat, return_inverse=True)


def _asker(top: int):
    def ask(key: tuple, block: pa.Table) -> pa.Table:
        """The block's different words and n-grams by segment, with their counts in training texts."""
        batches, offsets, words = _read_block(block)
        train = np.concatenate([np.repeat(_column(b, "train").to_numpy(zero_copy_only=False), np.diff(o)) for b, o in zip(batches, offsets, strict=True)])
        out, cuts = {}, {}
        grams = [ngrams(o, w) for o, w in zip(offsets, words, strict=True)]
        for name, parts, weight in (("word", words, train), ("gram", [g[k] for k in range(3) for g in grams], np.tile(train, 3))):
            different, at = _numbered(parts)
            counts = np.bincount(at, weight, minlength=len(different)).astype(np.int64)
            segment, keys = split(different, top)
            cuts[name] = np.searchsorted(segment, np.arange((1 << top) + 1))
            out[name] = (different if name == "word" else keys), counts

        def pieces(name: str, k: int) -> list[bytes]:
            put = pack_counts if k else np.ndarray.tobytes
            return [put(out[name][k][a:b]) for a, b in zip(cuts[name][:-1], cuts[name][1:], strict=True)]

        # A segment of which the block has nothing gets no row, so there are never more rows than n-grams.
        some = np.flatnonzero((np.diff(cuts["word"]) > 0) | (np.diff(cuts["gram"]) > 0))
        sent = {f"{name}{end}": pieces(name, k) for name in ("word", "gram") for k, end in ((0, "s"), (1, "_counts"))}
        return pa.table(
            {
                "segment": pa.array(some.astype(np.int32)),
                "block": pa.array([key[0].as_py()] * len(some), pa.int64()),
                **{name: pa.array([parts[i] for i in some], pa.binary()) for name, parts in sent.items()},
            }
        )

    return ask


ASKED = "segment int, block long, words binary, word_counts binary, grams binary, gram_counts binary"
ANSWER = "block long, segment int, totals binary, n_words long, levels binary, tokens long, known long, bits binary"


def _answerer(whole: bool):
    def answer(key: tuple, asked: pa.Table) -> pa.Table:
        """Word totals and levels for each block in its own order; the first row has the segment's sums, and its bits if they are wanted."""
        read = lambda name, kind: [np.frombuffer(x, kind) for x in asked.column(name).to_pylist()]

        def total(name: str, kind) -> tuple[np.ndarray, np.ndarray, np.ndarray, list[int]]:
            parts = read(f"{name}s", kind)
            different, at = _numbered(parts)
            counts = [unpack_counts(x, len(p)) for x, p in zip(asked.column(f"{name}_counts").to_pylist(), parts, strict=True)]
            sums_ = np.bincount(at, np.concatenate(counts), minlength=len(different)).astype(np.int64)
            return different, sums_, at, np.cumsum([len(x) for x in parts])[:-1]

        _, totals, at, ends = total("word", np.uint64)
        back = [pack_counts(x) for x in np.split(totals[at], ends)]
        lengths = np.diff([0, *ends, len(at)])
        keys, counts, at, ends = total("gram", np.uint32)
        bits = segment_bits(keys[counts > 0], counts[counts > 0])
        n = asked.num_rows
        if whole:
            levels = [b""] * n
        else:
            level = LogBloom([bits]).levels_at(np.zeros(len(keys), np.int64), keys)
            levels = [x.tobytes() for x in np.split(level[at], ends)]
        return pa.table(
            {
                "block": asked.column("block"),
                "segment": asked.column("segment"),
                "totals": pa.array(back, pa.binary()),
                "n_words": pa.array(lengths, pa.int64()),
                "levels": pa.array(levels, pa.binary()),
                "tokens": pa.array([int(totals.sum())] + [0] * (n - 1), pa.int64()),
                "known": pa.array([int((totals > 0).sum())] + [0] * (n - 1), pa.int64()),
                "bits": pa.array([bits.tobytes() if whole else None] + [None] * (n - 1), pa.binary()),
            }
        )

    return answer


SCORES = "doc_id long, held_out boolean, n_tokens long, n_known long, logs double, score double"


def chances(words: np.ndarray, pairs: np.ndarray, triples: np.ndarray, offsets: np.ndarray, n: float) -> np.ndarray:
    """The probability of each token from the count estimates of its n-grams; n is N + V + 1."""
    end = words[offsets[1] - 1]  # each text ends with the end token, and follows on one
    p = (words + 1) / n
    for counts, history in ((pairs, _before(offsets, words, end)), (triples, _before(offsets, pairs, 0.0))):
        seen = history > 0
        share = np.minimum(counts / np.where(seen, history, 1.0), 1.0)
        p = np.where(seen, MIX * share + (1 - MIX) * p, p)
    return p


def _scorer(n: float, sent):
    def score(block: pa.Table, answers: pa.Table) -> pa.Table:
        """A row for each document of the block."""
        batches, offsets, words = _read_block(block)
        answers = answers.sort_by("segment")
        totals = zip(answers.column("totals").to_pylist(), answers.column("n_words").to_pylist(), strict=True)
        totals = np.concatenate([unpack_counts(x, n) for x, n in totals])
        _, at = _numbered(words)
        grams = [ngrams(o, w) for o, w in zip(offsets, words, strict=True)]
        if sent is None:
            _, place_ = _numbered([g[k] for k in range(3) for g in grams])
            counts = estimate(np.frombuffer(b"".join(answers.column("levels").to_pylist()), np.uint8))[place_].reshape(3, -1)
        ends = np.cumsum([0, *map(len, words)])
        out = []
        for i, (batch, o) in enumerate(zip(batches, offsets, strict=True)):
            some = slice(ends[i], ends[i + 1])
            total = totals[at[some]]
            three = [estimate(sent.value.levels(g)) for g in grams[i]] if sent else counts[:, some]
            out.append(
                pa.table(
                    {
                        "doc_id": _column(batch, "doc_id"),
                        "held_out": pa.array(_column(batch, "train").to_numpy(zero_copy_only=False) == 0),
                        "n_tokens": pa.array(np.diff(o)),
                        "n_known": pa.array(sums(o, (total > 0).astype(np.int64))),
                        "logs": pa.array(sums(o, np.log10(total + 1.0))),
                        "score": pa.array(sums(o, np.log10(chances(*three, o, n)))),
                    }
                )
            )
        return pa.concat_tables(out)

    return score


def score_documents(docs: DataFrame, broadcast_bits: int = BROADCAST_BITS) -> DataFrame:
    """doc_id, held_out, n_tokens, n_known, train_tokens, base_score and score of every document."""
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"),
        F.coalesce("text", F.lit("")).alias("text"),
        F.coalesce((F.pmod(F.crc32(F.col("doc_id").cast("string").cast("binary")), F.lit(7)) != 2).cast("int"), F.lit(1)).alias("train"),
    )
    # Words are at most one more than the gaps that part them; this sizes segments and blocks and bounds the filter.
    gaps = F.length("text") - F.length(F.translate("text", " \t\n\x0b\x0c\r", "")) + 2
    size = rows.agg(F.sum(F.octet_length("text")).alias("bytes"), F.sum(gaps).alias("tokens")).first()
    n_tokens = size["tokens"] or 0
    top = max(4, (n_tokens // SEGMENT_TOKENS).bit_length())
    # A count has no more levels than its value, so the levels are at most three times the tokens; rooms are rounded up to a power of two.
    whole = 2 * 3 * BITS_A_LEVEL * n_tokens + (64 << top) <= broadcast_bits
    blocks = max(1, -(-(size["bytes"] or 0) // BLOCK_BYTES))
    dealt = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))
    with scratch():
        asked = dealt.groupBy("block").applyInArrow(_asker(top), ASKED)
        answers = saved(asked.groupBy("segment").applyInArrow(_answerer(whole), ANSWER), "answers")
        sums_ = answers.agg(F.sum("tokens").alias("n"), F.sum("known").alias("v")).first()
        n, v = sums_["n"] or 0, sums_["v"] or 0
        sent = None
        if whole:
            found = {r["segment"]: r["bits"] for r in answers.where("bits is not null").select("segment", "bits").toLocalIterator()}
            segments = [np.frombuffer(found.get(k, b"\0" * 8), np.uint8) for k in range(1 << top)]
            sent = docs.sparkSession.sparkContext.broadcast(LogBloom(segments))
        replies = answers.select("block", "segment", "totals", "n_words", "levels")
        scored = dealt.groupBy("block").cogroup(replies.groupBy("block")).applyInArrow(_scorer(float(n + v + 1), sent), SCORES)
        scored = saved(scored, "scores", outer=True)
    base = F.col("logs") - F.col("n_tokens") * F.log10(F.lit(float(n + v + 1)))
    return scored.select("doc_id", "held_out", "n_tokens", "n_known", F.lit(n).cast("long").alias("train_tokens"), base.alias("base_score"), "score")


def op8_lm_scoring(spark, sf_dir) -> DataFrame:
    return score_documents(spark.read.parquet(f"{sf_dir}/documents.parquet"))
