"""Licence scan: headers and licence files against templates, then inheritance by directory.

Method: texts are sparse TF-IDF vectors; document frequencies count every whole text. Windows of
consecutive lines as long as a template are compared with it by cosine (a header). The templates are
whole licence texts and usual notices. A licence file is a text that as a whole is like a whole
licence text, and not much shorter, or a file that is named like one and holds a header; a text with a
notice in it is none. A file without a licence of its own takes that of the licence file in the nearest directory
above it, found by joining the directories of all files, each with its ancestors, to the
directories that hold licence files.
"""

from __future__ import annotations

import math
import zlib
from collections import Counter
from collections.abc import Iterator, Sequence
from importlib import resources

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from municare.llm.common import map_texts, sliced, stored, texts_of

# Usual notices; the whole texts of licences follow from ``license_texts``.
NOTICES = (
    ("MIT", "Released under the MIT License."),
    ("MIT", "This project is licensed under the MIT License - see the LICENSE file for details."),
    ("MIT", "Use of this source code is governed by an MIT-style license that can be found in the LICENSE file."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\"); you may not use this file except in compliance with the License. You may obtain a copy of the License at http://www.apache.org/licenses/LICENSE-2.0 Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an \"AS IS\" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied. See the License for the specific language governing permissions and limitations under the License."),
    ("BSD-3-Clause", "Licensed under the BSD 3-Clause License."),
    ("BSD-3-Clause", "Use of this source code is governed by a BSD-style license that can be found in the LICENSE file."),
    ("BSD-2-Clause", "Licensed under the BSD 2-Clause License."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("GPL-3.0", "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program. If not, see <https://www.gnu.org/licenses/>."),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version."),
    ("GPL-2.0", "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version. This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE. See the GNU General Public License for more details. You should have received a copy of the GNU General Public License along with this program; if not, write to the Free Software Foundation, Inc., 51 Franklin Street, Fifth Floor, Boston, MA 02110-1301 USA."),
    ("LGPL-3.0", "This library is free software: you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version."),
    ("LGPL-2.1", "This library is free software; you can redistribute it and/or modify it under the terms of the GNU Lesser General Public License as published by the Free Software Foundation; either version 2.1 of the License, or (at your option) any later version."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0."),
    ("MPL-2.0", "This Source Code Form is subject to the terms of the Mozilla Public License, v. 2.0. If a copy of the MPL was not distributed with this file, You can obtain one at https://mozilla.org/MPL/2.0/."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "This work is licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
)
# Names of licence files, with or without an ending.
FILE_NAME = r"(?i)^(un)?licen[cs]e|^copying|^copyright|^notice"
FILE_SHARE = 0.5  # least share of a licence text's length
_TEXTS = resources.files("municare.llm") / "license_texts"
WHOLE = tuple(
    (f.name.removesuffix(".txt"), f.read_text("utf-8")) for f in sorted(_TEXTS.iterdir(), key=lambda f: f.name)
)
TEMPLATES = NOTICES + WHOLE
LINE_COSINE = 0.75
FILE_COSINE = 0.5
_REMEMBERED = 500_000  # words whose weights a worker holds
BITS = 18  # document frequencies are counted in 2**BITS hashed cells
_EDGES = b".,;:!?()[]{}<>\"'`*#/|-"


def terms(text: bytes) -> Counter:
    """Lower-cased words without punctuation at their ends."""
    count: Counter = Counter()
    for word, n in Counter(text.lower().split()).items():
        bare = word.strip(_EDGES)
        if bare:
            count[bare] += n
    return count


def _cell(term: bytes) -> int:
    return zlib.crc32(term) & ((1 << BITS) - 1)


def document_frequencies(documents: DataFrame, text: str = "text") -> tuple[int, np.ndarray]:
    """Number of texts, and per hashed cell the texts that hold one of its terms."""

    def counted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, texts = np.zeros(1 << BITS, np.int64), 0
        for batch in sliced(batches):
            for t in texts_of(batch.column(0)):
                if t is not None:
                    texts += 1
                    total[list({_cell(term) for term in terms(t)})] += 1
        at = np.flatnonzero(total)
        # Cell -1 counts the texts.
        cells, counts = np.append(at, -1), np.append(total[at], texts)
        yield pa.RecordBatch.from_arrays([pa.array(cells), pa.array(counts)], names=["cell", "n"])

    cells = documents.select(f"`{text}`").mapInArrow(counted, "cell bigint, n bigint")
    found = cells.groupBy("cell").agg(F.sum("n").alias("n")).toPandas()  # 2**BITS + 1 rows at most
    out = np.zeros(1 << BITS, np.int64)
    known = found[found["cell"] >= 0]
    out[known["cell"].to_numpy()] = known["n"].to_numpy()
    return int(found.loc[found["cell"] < 0, "n"].sum()), out


class Matcher:
    """Cosines of texts to the templates."""

    def __init__(
        self,
        texts: int,
        frequencies: np.ndarray,
        templates: Sequence[tuple[str, str]],
        least: float,
        line_least: float = LINE_COSINE,
        whole: Sequence[tuple[str, str]] = WHOLE,
    ):
        self.texts, self.frequencies, self.line_least = texts, frequencies, line_least
        self.names = [name for name, _ in templates]
        counted = [terms(text.encode()) for _, text in templates]
        self.lengths = [sum(counts.values()) for counts in counted]
        self._forget()
        self.vectors = [self.vector(counts) for counts in counted]
        # Only these can make a text a licence file.
        self.whole = [i for i, template in enumerate(templates) if template in whole]
        self.needed = {t for i in self.whole for t in _needed(self.vectors[i], least)}
        self.holders: dict[bytes, list[tuple[int, float]]] = {}
        for i, vector in enumerate(self.vectors):
            for term, weight in vector.items():
                self.holders.setdefault(term, []).append((i, weight))
        # Column 0 is for the terms that no template has.
        self.column = {term: i + 1 for i, term in enumerate(self.holders)}
        self.weights = np.zeros((len(self.vectors), len(self.column) + 1))
        self.marks = np.zeros(self.weights.shape, bool)
        for i, vector in enumerate(self.vectors):
            for term, weight in vector.items():
                self.weights[i, self.column[term]] = weight
            self.marks[i, [self.column[t] for t in _needed(vector, line_least)]] = True
        self.marked = {t for v in self.vectors for t in _needed(v, line_least)}
        self._forget()

    def _forget(self) -> None:
        self.words: dict[bytes, int] = {}
        self.known: dict[bytes, int] = {}
        self.idf, self.columns = np.zeros(1 << 12), np.zeros(1 << 12, np.int64)

    def weight(self, term: bytes) -> float:
        return 1.0 + math.log((1 + self.texts) / (1 + int(self.frequencies[_cell(term)])))

    def vector(self, counts: Counter) -> dict[bytes, float]:
        weights = {t: n * self.weight(t) for t, n in counts.items()}
        norm = math.sqrt(sum(w * w for w in weights.values()))
        return {t: w / norm for t, w in weights.items()}

    def best(self, counts: Counter) -> tuple[float, str | None]:
        """Highest cosine to a whole licence text that is not twice as long, and its licence, the first by
        name at a tie."""
        if self.needed.isdisjoint(counts):
            return 0.0, None
        cosines = [0.0] * len(self.names)
        for term, weight in self.vector(counts).items():
            for i, w in self.holders.get(term, ()):
                cosines[i] += w * weight
        size = sum(counts.values())
        found = [(-round(cosines[i], 9), self.names[i]) for i in self.whole if size >= FILE_SHARE * self.lengths[i]]
        cosine, name = min(found, default=(0.0, None))
        return -cosine, name

    def _number(self, word: bytes) -> int:
        """Number of the bare term of ``word``, -1 without one."""
        bare = word.strip(_EDGES)
        at = self.known.get(bare) if bare else -1
        if at is None:
            at = self.known[bare] = len(self.known)
            if at == len(self.idf):
                self.idf, self.columns = np.append(self.idf, np.zeros(at)), np.append(self.columns, np.zeros(at, np.int64))
            self.idf[at], self.columns[at] = self.weight(bare), self.column.get(bare, 0)
        self.words[word] = at
        return at

    def header(self, text: bytes) -> tuple[str | None, float, int | None]:
        """Licence, cosine and first line of the best window of whole lines that reaches
        ``line_least``: each line, each paragraph, and from each line on the most lines within
        the length of a template and the fewest that reach it. Lines without terms end a
        paragraph and count in no window. The first line counts at a tie, then the name."""
        if len(self.words) > _REMEMBERED:
            self._forget()
        numbers, ends, breaks, all_terms = [], [], [], []
        previous = -2
        for n, line in enumerate(text.lower().split(b"\n")):
            found = [self.words[w] if w in self.words else self._number(w) for w in line.split()]
            found = [i for i in found if i >= 0]
            if found:
                all_terms += found
                breaks.append(n != previous + 1)
                previous = n
                numbers.append(n)
                ends.append(len(all_terms))
        at = np.array(all_terms, np.int64)
        stop = np.array(ends, np.int64)
        start = np.concatenate([[0], stop[:-1]])
        lines = np.arange(len(stop))
        heads = np.flatnonzero(breaks)
        tails = np.append(heads[1:], len(stop)) - 1
        idf, columns = self.idf[at], self.columns[at]
        squares = idf * idf
        everything = np.concatenate([[0.0], np.cumsum(squares)])
        used = np.unique(columns)
        best = (0.0, 0, "")
        for i in np.flatnonzero(self.marks[:, used].any(axis=1)):
            weights = self.weights[i][columns]
            dots = np.concatenate([[0.0], np.cumsum(weights * idf)])
            foreign = np.concatenate([[0.0], np.cumsum(np.where(weights > 0, 0.0, squares))])
            over = np.minimum(np.searchsorted(stop, start + self.lengths[i], "left"), len(stop) - 1)
            for first, last in ((lines, lines), (heads, tails), (lines, over), (lines, np.maximum(over - 1, lines))):
                a, b = start[first], stop[last]
                dot = dots[b] - dots[a]
                # A term's square of a sum is at least the sum of its squares, and the terms of
                # the template alone weigh at least the dot product: the norm is no less.
                norm = np.sqrt(np.maximum(np.maximum(everything[b] - everything[a], dot * dot + foreign[b] - foreign[a]), 1e-300))
                may = np.flatnonzero((dot > 0) & (dot >= (self.line_least - 1e-9) * norm))
                for k, square in zip(may, _squared_norms(at, idf, a[may], b[may])):
                    cosine = round(dot[k] / math.sqrt(square), 9)
                    if cosine >= self.line_least:
                        best = min(best, (-cosine, numbers[first[k]], self.names[i]))
        return (best[2], -best[0], best[1]) if best[0] else (None, 0.0, None)

    def scan(self, text: bytes | None) -> tuple[str | None, float, int | None, str | None, float]:
        """Licence, cosine and first line of the best window, licence and cosine of the whole text."""
        whole = terms(text) if text else Counter()
        cosine, name = self.best(whole)
        none = (None, 0.0, None) if self.marked.isdisjoint(whole) else self.header(text)
        return *none, name, cosine


def _needed(vector: dict[bytes, float], least: float) -> set[bytes]:
    """By Cauchy and Schwarz a text that shares only terms of a smaller norm than ``least``
    stays below it, so it has to hold one of the others, which are returned."""
    room, needed = least**2, set()
    for term, weight in sorted(vector.items(), key=lambda x: (x[1], x[0])):
        room -= weight**2
        if room <= 0:
            needed.add(term)
    return needed


def _squared_norms(terms_at: np.ndarray, idf: np.ndarray, starts: np.ndarray, stops: np.ndarray) -> Iterator[float]:
    """Squared TF-IDF norm of each window. Starts and stops ascend, so that a word comes in once
    and goes out once."""
    counts: Counter = Counter()
    total, low, high = 0.0, 0, 0
    for a, b in zip(starts.tolist(), stops.tolist()):
        if a >= high:
            counts.clear()
            total, low, high = 0.0, a, a
        for t, w in zip(terms_at[high:b].tolist(), idf[high:b].tolist()):
            total += (2 * counts[t] + 1) * w * w
            counts[t] += 1
        for t, w in zip(terms_at[low:a].tolist(), idf[low:a].tolist()):
            counts[t] -= 1
            total -= (2 * counts[t] + 1) * w * w
        low, high = a, b
        yield total


def directory_of(path: Column) -> Column:
    """What is before the last ``/``; empty for a file at the root."""
    return F.regexp_extract(path, r"(?s)^(.*)/[^/]*$", 1)


def inherited(files: DataFrame) -> DataFrame:
    """(dir, license, from_dir) for the directories of ``files`` (dir, file_license, file_cosine)
    that have a licence file in them or above; the nearest directory counts. Of several files in
    one directory the one with the highest cosine counts, then the first licence by name."""
    held = files.filter("dir is not null and file_license is not null").groupBy("dir")
    held = held.agg(F.min(F.struct(-F.col("file_cosine"), F.col("file_license").alias("license"))).alias("best"))
    held = stored(held.select(F.col("dir").alias("from_dir"), F.col("best.license").alias("license")), "held")
    parts = F.split("dir", "/")
    depths = F.sequence(F.lit(0), F.when(F.col("dir") == "", 0).otherwise(F.size(parts)))
    dirs = files.filter("dir is not null").select("dir").distinct().select("dir", F.explode(depths).alias("depth"))
    dirs = dirs.withColumn("above", F.array_join(F.slice(parts, 1, F.col("depth")), "/"))
    found = stored(dirs, "ancestors").join(held, F.col("above") == F.col("from_dir"))
    nearest = found.groupBy("dir").agg(F.max(F.struct("depth", "license", "from_dir")).alias("near"))
    return nearest.select("dir", "near.license", "near.from_dir")


def scan_licenses(
    files: DataFrame,
    templates: Sequence[tuple[str, str]] = TEMPLATES,
    line_cosine: float = LINE_COSINE,
    file_cosine: float = FILE_COSINE,
) -> DataFrame:
    """Per row of ``files`` (doc_id, path, text): doc_id, path, header_license, header_cosine,
    header_line, file_license, file_cosine, license, from_dir.

    ``file_license`` is set for licence files, by text or by name, with the cosine of the whole text or of
    the header. ``license`` is that, else that of the best window of lines, else the inherited one, and
    ``from_dir`` then names the directory it comes from. Null and empty texts have none of their
    own; a null path inherits nothing. ``header_line`` is the first line of the window, of equal
    ones the first; ``header_cosine`` is 0 below the threshold. Repeated rows are scanned each;
    other columns are not read.
    """
    slim = files.select("doc_id", "path", "text")
    number, frequencies = document_frequencies(slim)
    state = {"number": number, "frequencies": frequencies}
    shared = files.sparkSession.sparkContext.broadcast(state)

    def each(texts):
        known = shared.value
        if "match" not in known:  # one per worker
            known["match"] = Matcher(known["number"], known["frequencies"], templates, file_cosine, line_cosine)
        match = known["match"]
        names, cosines, lines, whole, whole_cosines = zip(*map(match.scan, texts)) if texts else ([],) * 5
        sure = [n if c >= line_cosine else None for n, c in zip(names, cosines)]
        return {
            "header_license": pa.array(sure, pa.string()),
            "header_cosine": pa.array(cosines, pa.float64()),
            "header_line": pa.array([n if s else None for n, s in zip(lines, sure)], pa.int32()),
            "file_license": pa.array([n if c >= file_cosine else None for n, c in zip(whole, whole_cosines)], pa.string()),
            "file_cosine": pa.array(whole_cosines, pa.float64()),
        }

    schema = "header_license string, header_cosine double, header_line int, file_license string, file_cosine double"
    rows = map_texts(slim, ["doc_id", "path"], "text", each, schema)
    named = F.regexp_extract("path", r"(?s)([^/]*)$", 1).rlike(FILE_NAME) & F.col("file_license").isNull()
    by_name = named & F.col("header_license").isNotNull()
    rows = rows.withColumns({
        "file_license": F.when(by_name, F.col("header_license")).otherwise(F.col("file_license")),
        "file_cosine": F.when(by_name, F.col("header_cosine")).otherwise(F.col("file_cosine")),
    })
    rows = stored(rows.withColumn("dir", directory_of(F.col("path"))), "scanned")
    above = inherited(rows).select(F.col("dir").alias("__dir"), F.col("license").alias("__license"), "from_dir")
    joined = rows.join(stored(above, "inherited"), F.col("dir") == F.col("__dir"), "left")
    own = F.coalesce("file_license", "header_license")
    return joined.select(
        *[c for c in rows.columns if c != "dir"],
        F.coalesce(own, "__license").alias("license"),
        F.when(own.isNull(), F.col("from_dir")).alias("from_dir"),
    )
