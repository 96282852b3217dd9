"""License scan: a positional rare-token index over licence templates.

Every template (and every short phrase) is a row of words. For each the words
that must be there (its key phrases) are ranked by inverse document frequency,
counted over the whole corpus; the two rarest are posted: word to (template,
offset). The words of a file are looked up in these postings, and the pairs are
intersected by relative position: a file position minus its template offset says
where the template would start. Only at starts that both words agree on are the
key phrases verified word by word and the rest of the template weighed. No step
goes through the templates; words that are common everywhere are posted for those
templates alone that have no rarer ones.

Both passes run batch by batch over Arrow buffers; nothing is shuffled but one
count per template word and task.

Defined cases: null text is empty; an empty text has no words and no match;
null or repeated ids are passed through, one result row per input row; other
columns of the input are neither read nor returned; an empty table gives none.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from rawgate.llm.common import ALNUM_WORD, IS_ALNUM, arrow_map, find_words, hash_words, row_of, slices, table, word_hashes
from rawgate.llm.registry import query

#: Short phrases and their labels.
BASE_PHRASES = (
    ("mit license", "mit"),
    ("apache license", "apache"),
    ("general public license", "gpl"),
)

#: Label, template, key phrases that must stand in it.
TEMPLATES = (
    ("agpl-3.0", "licensed under the GNU Affero General Public License, version 3", ("gnu affero general public license",)),
    ("apache-2.0", "Licensed under the Apache License, Version 2.0", ("apache license", "version 2 0")),
    ("apache-2.0-notice", "you may not use this file except in compliance with the License", ("except in compliance with the license",)),
    ("bsd", "Redistribution and use in source and binary forms, with or without modification, are permitted", ("redistribution and use in source and binary forms",)),
    ("cc-by-4.0", "Licensed under CC BY 4.0", ("cc by 4 0",)),
    ("cc-by-nc-4.0", "Licensed under CC BY-NC 4.0", ("cc by nc 4 0",)),
    ("cc-by-sa-4.0", "Licensed under CC BY-SA 4.0", ("cc by sa 4 0",)),
    ("cc0", "released under CC0 1.0 Universal", ("cc0 1 0",)),
    ("gpl-2.0", "licensed under the GNU General Public License, version 2", ("gnu general public license", "version 2")),
    ("gpl-3.0", "licensed under the GNU General Public License, version 3", ("gnu general public license", "version 3")),
    ("isc", "Permission to use, copy, modify, and/or distribute this software for any purpose", ("permission to use copy modify and or distribute",)),
    ("lgpl", "licensed under the GNU Lesser General Public License", ("gnu lesser general public license",)),
    ("mit-grant", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software", ("permission is hereby granted free of charge",)),
    (
        "mit-text",
        "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "
        '"Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, '
        "distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to "
        "the following conditions: The above copyright notice and this permission notice shall be included in all copies or substantial portions "
        'of the Software. THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE '
        "WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS "
        "BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN "
        "CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE.",
        ("permission is hereby granted free of charge", "included in all copies or substantial portions"),
    ),
    (
        "isc-text",
        "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the "
        'above copyright notice and this permission notice appear in all copies. THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL '
        "WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE "
        "LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, "
        "WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
        "SOFTWARE.",
        ("permission to use copy modify and or distribute", "notice appear in all copies"),
    ),
    ("mit-notice", "Released under the MIT License", ("mit license",)),
    ("mpl-2.0", "subject to the terms of the Mozilla Public License, v. 2.0", ("mozilla public license",)),
    ("unlicense", "This is free and unencumbered software released into the public domain", ("free and unencumbered software",)),
)

MIN_COVERAGE = 0.6


@dataclass(frozen=True)
class Template:
    label: str
    words: tuple[str, ...]
    required: tuple[int, ...]
    base: bool


def _words(text: str) -> tuple[str, ...]:
    import re

    lower = "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in text)
    return tuple(re.findall(ALNUM_WORD, lower))


def make_template(label: str, text: str, key_phrases: tuple[str, ...], base: bool = False) -> Template:
    """`required` are the offsets at which words of the key phrases stand in the template."""
    words, required = _words(text), set()
    for phrase in key_phrases:
        key = _words(phrase)
        at = next((i for i in range(len(words) - len(key) + 1) if words[i : i + len(key)] == key), None)
        if at is None or not key:
            raise ValueError(f"template {label!r} lacks its key phrase {phrase!r}")
        required.update(range(at, at + len(key)))
    return Template(label, words, tuple(sorted(required)), base)


def templates_of(
    phrases: tuple[tuple[str, str], ...] = BASE_PHRASES, templates: tuple[tuple[str, str, tuple[str, ...]], ...] = TEMPLATES
) -> list[Template]:
    return [make_template(label, text, (text,), base=True) for text, label in phrases] + [make_template(*t) for t in templates]


def _ragged(sizes: np.ndarray) -> np.ndarray:
    """0, 1, ... for each of the sizes, one after the other."""
    return np.arange(int(sizes.sum())) - np.repeat(np.cumsum(sizes) - sizes, sizes)


class LicenseIndex:
    """Postings of licence words: word to the (template, offset) pairs at which it is one of the template's two rarest required words.

    Words are numbered, templates laid end to end, so that a lookup is a slice.
    """

    def __init__(self, templates: list[Template], document_frequency: dict[str, int] | None = None, n_docs: int = 0):
        self.templates = templates
        self.vocabulary = sorted({w for t in templates for w in t.words})
        hashes = hash_words(self.vocabulary)
        order = np.argsort(hashes)
        self.sorted_hashes = hashes[order]
        self.term_ids = order.astype(np.int64)
        of = {w: i for i, w in enumerate(self.vocabulary)}
        frequency = document_frequency or {}
        self.idf = np.array([np.log((n_docs + 1) / (frequency.get(w, 0) + 1)) + 1 for w in self.vocabulary])
        self.sizes = np.array([len(t.words) for t in templates], dtype=np.int64)
        self.firsts = np.cumsum(self.sizes) - self.sizes
        self.terms = np.array([of[w] for t in templates for w in t.words], dtype=np.int64)
        self.required = np.zeros(len(self.terms), dtype=bool)
        self.weights = np.array([self.idf[self.terms[f : f + n]].sum() for f, n in zip(self.firsts, self.sizes, strict=True)])
        self.two = np.zeros(len(templates), dtype=bool)
        posted: tuple[list[tuple[int, int, int]], ...] = ([], [])
        for i, t in enumerate(templates):
            self.required[self.firsts[i] + np.array(t.required)] = True
            probes = self._probes(t, self.terms[self.firsts[i] : self.firsts[i] + self.sizes[i]])
            self.two[i] = len(probes) == 2
            for rank, offset in enumerate(probes):
                posted[rank].append((int(self.terms[self.firsts[i] + offset]), i, offset))
        self.postings = [self._postings(sorted(p)) for p in posted]

    def _probes(self, template: Template, terms: np.ndarray) -> list[int]:
        """Offsets of the two rarest required words (one, if all are the same word)."""
        ranked = sorted(template.required, key=lambda j: (-self.idf[terms[j]], j))
        first = ranked[0]
        second = next((j for j in ranked if terms[j] != terms[first]), None)
        return [first] if second is None else [first, second]

    def _postings(self, listed: list[tuple[int, int, int]]) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(slice of each word, templates, offsets)"""
        term, template, offset = (np.array([x[k] for x in listed], dtype=np.int64) for k in range(3))
        return np.searchsorted(term, np.arange(len(self.vocabulary) + 1)), template, offset

    def terms_at(self, hashes: np.ndarray) -> np.ndarray:
        """Term number of each word, -1 for words of no template."""
        at = np.searchsorted(self.sorted_hashes, hashes)
        at[at == len(self.sorted_hashes)] = 0
        return np.where(self.sorted_hashes[at] == hashes, self.term_ids[at], -1)

    def _look_up(self, rank: int, at: np.ndarray, term: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """(template, start) of every posting of the words that stand at the given places."""
        slices_, template, offset = self.postings[rank]
        n = slices_[term + 1] - slices_[term]
        where = np.repeat(slices_[term], n) + _ragged(n)
        return template[where], np.repeat(at, n) - offset[where]

    def matches(self, terms: np.ndarray, rows: np.ndarray, min_coverage: float) -> tuple[np.ndarray, ...]:
        """Verified places: template, row, start (a word number of the slice), coverage, words in place.

        The words of the files drive the search: the postings of the rarest words
        are intersected with those of the second rarest on (template, start). Its
        cost is that of the postings met, whatever the number of templates.
        """
        at = np.flatnonzero(terms >= 0)
        n, far = len(terms), int(self.sizes.max(initial=0)) + 1

        def key(template: np.ndarray, start: np.ndarray) -> np.ndarray:
            return template * (n + 2 * far) + start + far

        template, start = self._look_up(0, at, terms[at])
        other = key(*self._look_up(1, at, terms[at]))
        met = np.isin(key(template, start), other) | ~self.two[template]
        template, start = template[met], start[met]
        if not len(start):
            none = np.zeros(0, np.int64)
            return none, none, none, np.zeros(0), none
        size = self.sizes[template]
        inner = np.repeat(self.firsts[template], size) + _ragged(size)
        place = np.repeat(start, size) + _ragged(size)
        probe = np.clip(place, 0, n - 1)
        # the row is that of any required word; the first probe stands in it
        first_required = self.firsts[template] + np.array([t.required[0] for t in self.templates], dtype=np.int64)[template]
        row = rows[np.clip(start + first_required - self.firsts[template], 0, n - 1)]
        equal = (place >= 0) & (place < n) & (terms[probe] == self.terms[inner]) & (rows[probe] == np.repeat(row, size))
        cut = np.cumsum(size) - size
        whole = np.logical_and.reduceat(equal | ~self.required[inner], cut)
        coverage = np.minimum(np.add.reduceat(equal * self.idf[self.terms[inner]], cut) / self.weights[template], 1.0)
        good = whole & (coverage >= min_coverage)
        return template[good], row[good], start[good], coverage[good], np.add.reduceat(equal.astype(np.int64), cut)[good]


def _text_and_id(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(id_col).alias("_id"), F.col(text_col).cast("string").alias("_text"))


def document_frequencies(docs: DataFrame, templates: list[Template], text_col: str = "text") -> tuple[dict[str, int], int]:
    """In how many documents each template word stands, over the whole corpus, and the number of documents."""
    index = LicenseIndex(templates)
    size = len(index.vocabulary)

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        totals = np.zeros(size + 1, dtype=np.int64)
        for batch in batches:
            totals[size] += batch.num_rows
            for _, _, buf, offsets in slices(batch.column(0)):
                starts, ends, pointer = find_words(buf, offsets, IS_ALNUM)
                terms = index.terms_at(word_hashes(buf, starts, ends))
                hit = terms >= 0
                pairs = np.unique(row_of(pointer)[hit] * size + terms[hit])
                totals[:size] += np.bincount(pairs % size, minlength=size)
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(size + 1)), pa.array(totals)], names=["term", "n"])

    counted = (
        docs.select(F.col(text_col).cast("string").alias("_text")).transform(arrow_map, count, "term long, n long").groupBy("term").agg(F.sum("n").alias("n"))
    )
    by_term = {r["term"]: r["n"] for r in counted.collect()}  # a row per template word
    return {w: int(by_term.get(i, 0)) for i, w in enumerate(index.vocabulary)}, int(by_term.get(size, 0))


MATCH = "struct<label:string,base:boolean,start:bigint,n_words:bigint,coverage:double>"


def scan_licenses(
    docs: DataFrame,
    templates: list[Template] | None = None,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_coverage: float = MIN_COVERAGE,
) -> DataFrame:
    """One row per document: id, n_words and `matches`, each with label, base flag, first word, words in place, coverage."""
    templates = templates_of() if templates is None else templates
    frequency, n_docs = document_frequencies(docs, templates, text_col)
    index = LicenseIndex(templates, frequency, n_docs)
    labels = np.array([t.label for t in templates], dtype=object)
    base = np.array([t.base for t in templates], dtype=bool)

    def scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, stop, buf, offsets in slices(batch.column(1)):
                starts, ends, pointer = find_words(buf, offsets, IS_ALNUM)
                rows = row_of(pointer)
                terms = index.terms_at(word_hashes(buf, starts, ends))
                which, row, start, coverage, in_place = index.matches(terms, rows, min_coverage)
                order = np.lexsort((which, start, row))
                row, start, which = row[order], start[order], which[order]
                structs = pa.StructArray.from_arrays(
                    [
                        pa.array(labels[which], pa.string()),
                        pa.array(base[which], pa.bool_()),
                        pa.array(start - pointer[row], pa.int64()),
                        pa.array(in_place[order].astype(np.int64), pa.int64()),
                        pa.array(coverage[order], pa.float64()),
                    ],
                    names=["label", "base", "start", "n_words", "coverage"],
                )
                ends_of_rows = np.searchsorted(row, np.arange(stop - first + 1)).astype(np.int32)
                yield pa.RecordBatch.from_arrays(
                    [
                        batch.column(0).slice(first, stop - first),
                        pa.array(np.diff(pointer).astype(np.int64), pa.int64()),
                        pa.ListArray.from_arrays(pa.array(ends_of_rows), structs),
                    ],
                    names=[id_col, "n_words", "matches"],
                )

    schema = T.StructType(
        [
            T.StructField(id_col, docs.schema[id_col].dataType),
            T.StructField("n_words", T.LongType()),
            T.StructField("matches", T._parse_datatype_string(f"array<{MATCH}>")),
        ]
    )
    return _text_and_id(docs, id_col, text_col).transform(arrow_map, scan, schema)


@query("op1_license_scan")
def license_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = scan_licenses(table(spark, sf_dir, "documents"))
    base = F.filter("matches", lambda m: m["base"])
    starts = F.transform(base, lambda m: m["start"])

    def joined(matches):
        return F.array_join(F.array_sort(F.array_distinct(F.transform(matches, lambda m: m["label"]))), ",")

    best = F.array_max(F.transform(F.filter("matches", lambda m: ~m["base"]), lambda m: m["coverage"]))
    return found.select(
        "doc_id",
        "n_words",
        F.size(base).cast("long").alias("n_base"),
        F.array_min(starts).alias("first_word"),
        F.array_max(starts).alias("last_word"),
        joined(base).alias("base_labels"),
        joined(F.col("matches")).alias("labels"),
        F.greatest(F.when(F.size(base) > 0, 0.5).otherwise(0.0), F.coalesce(best, F.lit(0.0))).alias("score"),
    )
