"""License scan: sparse TF-IDF cosine of passages and whole files to templates, then inheritance by path.

Every line of a text, every window of as many consecutive words as a template has (so that wrapped
headers and notices within long lines are found), and the text as a whole is a passage. Words are weighted by idf over
all documents (words that no template has weigh as the rarest). The template with the highest
cosine of at least MIN_COSINE is the file's own license. A licence file is one that as a whole is one
of the templates, or whose first words are the title of a long licence: it licenses
its directory. A file without an own license takes that of the nearest ancestor
directory that has one: all directories are joined with the licensed ones over their ancestors.

Sums along the text give each passage's product with each template and a bound of its norm; only
passages that may reach MIN_COSINE by these are worked out.

Edge cases: null or empty texts have no own license; a null path inherits nothing and
licenses nothing; equal cosines go to a line, then a window, then the whole, then to the first template by name,
then to the first place; of several licence files
in a directory the best one counts, then the first by name; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import saved
from .decontaminate import words_of
from .license_texts import TEMPLATES, TITLES
from .words import offsets_of, slices

MIN_COSINE = 0.8
#: Words, and passages, whose cosines are worked out at once.
WORDS_AT_ONCE, PASSAGES_AT_ONCE = 1 << 20, 2048
#: Largest table of inherited licenses by directory that is broadcast.
BROADCAST_DIRS = 100_000


def document_counts(texts: DataFrame, vocabulary: list[str]) -> np.ndarray:
    """In how many documents each word of the vocabulary stands; over all documents."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known, df = pa.array(vocabulary, pa.string()), np.zeros(len(vocabulary), np.int64)
        for batch in slices(batches):
            offsets, flat = words_of(batch.column(0))
            codes = pc.fill_null(pc.index_in(flat, value_set=known), -1).to_numpy(zero_copy_only=False).astype(np.int64)
            text = np.repeat(np.arange(batch.num_rows), np.diff(offsets))[codes >= 0]
            df += np.bincount(np.unique(text * len(vocabulary) + codes[codes >= 0]) % len(vocabulary), minlength=len(vocabulary))
        some = np.flatnonzero(df)
        yield pa.RecordBatch.from_arrays([pa.array(some), pa.array(df[some])], names=["word", "df"])

    counts = texts.mapInArrow(run, "word long, df long").groupBy("word").agg(F.sum("df").alias("df"))
    df = np.zeros(len(vocabulary), np.int64)
    for row in counts.collect():
        df[row["word"]] = row["df"]
    return df


class Matcher:
    def __init__(self, templates: dict[str, tuple[str, ...]], titles: dict[str, tuple[str, ...]], counts, n_docs: int):
        known = sorted((name, k, text) for k, kind in enumerate((templates, titles)) for name in kind for text in kind[name])
        self.names = [name for name, _, _ in known]
        self.title = np.array([k == 1 for _, k, _ in known])
        offsets, flat = words_of(pa.array([text for _, _, text in known], pa.string()))
        self.lengths = np.diff(offsets)
        self.vocabulary = sorted(set(flat.to_pylist()))
        place = {w: i for i, w in enumerate(self.vocabulary)}
        # The last place stands for all other words: they are taken to differ, each adds its squared weight.
        self.idf = np.append(np.log((2 + n_docs) / (1 + counts(self.vocabulary))), np.log(2 + n_docs))
        self.rows = np.zeros((len(self.names), len(place) + 1))
        for k, (a, b) in enumerate(zip(offsets[:-1], offsets[1:], strict=True)):
            for w in flat[int(a) : int(b)].to_pylist():
                self.rows[k, place[w]] += self.idf[place[w]]
        self.rows /= np.maximum(np.sqrt((self.rows**2).sum(axis=1)), 1e-12)[:, None]

    def candidates(self, codes: np.ndarray, passages: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Which passages (starts, ends) may reach MIN_COSINE, and all windows that may.

        ends: the end of the text of each word. A word that repeats in a passage makes its norm only larger.
        """
        weights = self.idf[codes]
        least = np.concatenate([[0.0], np.cumsum(weights**2)])
        live, found = np.zeros(passages.shape[1], bool), [np.zeros((2, 0), np.int64)]
        for row, length in zip(self.rows, self.lengths.tolist(), strict=True):
            dot = np.concatenate([[0.0], np.cumsum(row[codes] * weights)])

            def may(a, b, dot=dot):
                inside = dot[b] - dot[a]
                return (inside > 1e-9) & (inside >= MIN_COSINE * np.sqrt(np.maximum(least[b] - least[a], 0)) - 1e-6)

            live |= may(*passages)
            if 0 < length <= len(codes):
                a = np.arange(len(codes) - length + 1)
                a = a[may(a, a + length)]
                a = a[ends[a] >= a + length]
                found.append(np.stack([a, a + length]))
        windows = np.concatenate(found, axis=1)
        return live, np.unique(windows, axis=1) if windows.size else windows

    def cosines(self, codes: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Best cosine and template of each passage."""
        sizes = ends - starts
        best, which = np.zeros(len(starts)), np.zeros(len(starts), np.int64)
        total, i = np.concatenate([[0], np.cumsum(sizes)]), 0
        while i < len(starts):
            j = max(i + 1, min(i + PASSAGES_AT_ONCE, int(np.searchsorted(total, total[i] + WORDS_AT_ONCE, side="right")) - 1))
            row = np.repeat(np.arange(j - i), sizes[i:j])
            words = codes[np.arange(total[j] - total[i]) + np.repeat(starts[i:j] - (total[i:j] - total[i]), sizes[i:j])]
            cells, n = np.unique(row * len(self.idf) + words, return_counts=True)
            row, words = cells // len(self.idf), cells % len(self.idf)
            other = words == len(self.idf) - 1
            norm = np.bincount(row, self.idf[words] ** 2 * np.where(other, n, n**2), j - i)
            tf = np.zeros((j - i, len(self.idf)))
            tf[row[~other], words[~other]] = n[~other] * self.idf[words[~other]]
            scores = tf @ self.rows.T / np.sqrt(np.maximum(norm, 1e-12))[:, None]
            scores = np.round(scores, 12)
            best[i:j], which[i:j] = scores.max(axis=1), scores.argmax(axis=1)
            i = j
        return best, which

    def scan(self, texts: pa.Array) -> list[tuple[str | None, float, int, bool]]:
        """License, cosine, line (-1: the whole text) and whether it is a licence file, of each text."""
        lists = pc.split_pattern(texts, "\n")
        per_text = offsets_of(lists)
        lines, flat = words_of(lists.flatten())
        codes = pc.index_in(flat, value_set=pa.array(self.vocabulary, pa.string()))
        codes = pc.fill_null(codes, len(self.vocabulary)).to_numpy(zero_copy_only=False).astype(np.int64)
        bounds = lines[per_text]
        passages = np.stack([np.concatenate([lines[:-1], bounds[:-1]]), np.concatenate([lines[1:], bounds[1:]])])
        kinds = np.repeat([0, 2], [len(lines) - 1, len(bounds) - 1])
        owners = np.concatenate([np.repeat(np.arange(len(texts)), np.diff(per_text)), np.arange(len(texts))])
        live, windows = self.candidates(codes, passages, np.repeat(bounds[1:], np.diff(bounds)))
        starts, ends = np.concatenate([passages[:, live], windows], axis=1)
        kinds = np.concatenate([kinds[live], np.ones(windows.shape[1], np.int64)])
        owners = np.concatenate([owners[live], np.searchsorted(bounds, windows[0], side="right") - 1])
        cosine, which = self.cosines(codes, starts, ends)
        good = cosine >= MIN_COSINE
        file = np.zeros(len(texts), bool)
        file[owners[good & ((kinds == 2) | self.title[which] & (starts == bounds[owners]))]] = True
        out = [(None, 0.0, -1, bool(f)) for f in file]
        seen = np.zeros(len(texts), bool)
        for k in np.lexsort((starts, which, kinds, -cosine)):
            t = int(owners[k])
            if good[k] and not seen[t]:
                seen[t] = True
                line = -1 if kinds[k] == 2 else int(np.searchsorted(lines, starts[k], side="right") - 1 - per_text[t])
                out[t] = (self.names[which[k]], float(cosine[k]), line, out[t][3])
        return out


def ancestors(path: str) -> str:
    """SQL for the directories above a path, nearest first, the root ('') last."""
    return (
        f"transform(sequence(size(split({path}, '/')) - 1, 0, -1), "
        f"i -> array_join(slice(split({path}, '/'), 1, i), '/'))"
    )


def license_scan(
    files: DataFrame,
    path: str = "path",
    *keep: str,
    templates: dict[str, tuple[str, ...]] = TEMPLATES,
    titles: dict[str, tuple[str, ...]] = TITLES,
) -> DataFrame:
    """keep, own_license, cosine, line, license (own or inherited) and inherited_from of every file."""
    n_docs = files.count()
    matcher = Matcher(templates, titles, lambda words: document_counts(files.select("text"), words), n_docs)
    sent = files.sparkSession.sparkContext.broadcast(matcher)
    cols = [*keep, path]
    source = files.select(*[F.col(c).alias(f"__{i}") for i, c in enumerate(cols)], "text")
    names = [f"__{i}" for i in range(len(cols))]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches):
            found = sent.value.scan(batch.column(len(names)))
            kinds = (pa.string(), pa.float64(), pa.int32(), pa.bool_())
            yield pa.RecordBatch.from_arrays(
                [*batch.columns[: len(names)], *(pa.array(c, k) for c, k in zip(zip(*found, strict=True), kinds, strict=True))],
                names=[*names, "own_license", "cosine", "line", "is_file"],
            )

    types = ", ".join(f"{n} {source.schema[n].dataType.simpleString()}" for n in names)
    rows = saved(source.mapInArrow(run, f"{types}, own_license string, cosine double, line int, is_file boolean"), "licenses")
    here = names[-1]
    rows = rows.withColumn("__dir", F.expr(f"if({here} is null, null, get({ancestors(here)}, 0))"))
    licensed = (
        rows.where("is_file and __dir is not null")
        .groupBy("__dir")
        .agg(F.min(F.struct(-F.col("cosine"), "own_license")).alias("__best"))
        .select(F.col("__dir").alias("__up"), F.col("__best.own_license").alias("__license"))
    )
    dirs = rows.where("__dir is not null").select("__dir").distinct()
    above = dirs.select("__dir", F.posexplode(F.expr(f"concat(array(__dir), if(__dir = '', array(), {ancestors('__dir')}))")).alias("__far", "__up"))
    near = above.join(licensed, "__up").groupBy("__dir").agg(F.min(F.struct("__far", "__up", "__license")).alias("__near"))
    near = saved(near.select(F.col("__dir").alias("__at"), "__near.__up", "__near.__license"), "inherited")
    if near.count() <= BROADCAST_DIRS:
        near = F.broadcast(near)
    out = rows.join(near, rows["__dir"] == near["__at"], "left")
    taken = F.col("own_license").isNull()
    return out.select(
        *[F.col(n).alias(c) for n, c in zip(names, cols, strict=True)][: len(keep)],
        "own_license",
        "cosine",
        "line",
        F.coalesce("own_license", "__license").alias("license"),
        F.when(taken, F.col("__up")).alias("inherited_from"),
    )


def op3_license_scan(spark, sf_dir) -> DataFrame:
    """Documents as files source/lang/doc_id."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    path = F.concat_ws("/", F.coalesce("source", F.lit("none")), F.coalesce("lang", F.lit("none")), F.coalesce(F.col("doc_id").cast("string"), F.lit("none")))
    return license_scan(docs.select("doc_id", "text", path.alias("path")), "path", "doc_id")
