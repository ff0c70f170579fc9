"""License scan with a generalised suffix automaton of licence tokens.

The automaton is built of token sequences: licence templates and the phrases that name
licences. A file is streamed through it; after each word the automaton gives the length
of the longest stretch of template text that ends there (the matching statistic).
Phrases that end there are counted. Maximal stretches of LONG words or more are chained
in order of file and template; a template that a chain covers far enough gives its
label, the largest share that is covered is the score.
"""

from __future__ import annotations

from collections import defaultdict

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from . import common
from .tokens import text_runs, words_of

#: Phrases whose places count, with their labels.
PHRASES = (("mit license", "mit"), ("apache license", "apache"), ("general public license", "gpl"))

#: Clauses and notices of the public licence texts, by label: openings first, then texts as a whole.
TEMPLATES = (
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction"),
    ("mit", "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    ("apache", "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at"),
    ("apache", "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    ("gpl", "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation"),
    ("gpl", "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    ("mpl", "this source code form is subject to the terms of the mozilla public license v 2 0"),
    ("cc-by", "this work is licensed under a creative commons attribution 4 0 international license"),
    ("cc-by", "licensed under cc by 4 0"),
    ("cc-by-sa", "licensed under cc by sa 4 0"),
    ("cc-by-nc", "licensed under cc by nc 4 0"),
    ("cc0", "to the extent possible under law the author has waived all copyright and related or neighboring rights to this work"),
    ("mit", "released under the mit license"),
    ("gpl", "gnu general public license version 3"),
    ("proprietary", "all rights reserved"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software"),
    ("bsd", "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    ("bsd", "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    ("bsd", "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    ("zlib", "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    ("unlicense", "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in source code form or as a compiled binary for any purpose commercial or non commercial and by any means"),
    ("gpl", "you should have received a copy of the gnu general public license along with this program if not see"),
)

#: Words of a stretch that takes part in a chain; those of shorter templates need the whole template.
LONG = 4
#: Words between two stretches of a chain, at most, in file and template.
GAP = 12
#: Share of a template that a chain has to cover.
COVER = 0.75

_BLANK = np.ones(256, bool)
_BLANK[[*range(48, 58), *range(97, 123), *range(128, 256)]] = False


class Automaton:
    """Generalised suffix automaton of sequences of word numbers."""

    def __init__(self, sequences: list[list[int]]):
        self.next: list[dict[int, int]] = [{}]
        self.link, self.len = [-1], [0]
        #: Of each state, for each sequence, where its longest string ends first.
        self.ends: list[dict[int, int]] = [{}]
        for number, sequence in enumerate(sequences):
            last = 0
            for at, word in enumerate(sequence):
                last = self._extend(last, word)
                self.ends[last].setdefault(number, at)
        for state in sorted(range(1, len(self.len)), key=self.len.__getitem__, reverse=True):
            for number, at in self.ends[state].items():
                up = self.ends[self.link[state]]
                up[number] = min(at, up.get(number, at))

    def _state(self, length: int, link: int, following: dict[int, int]) -> int:
        self.next.append(following)
        self.link.append(link)
        self.len.append(length)
        self.ends.append({})
        return len(self.len) - 1

    def _split(self, p: int, q: int, word: int) -> int:
        """The state of the string of length len[p] + 1 that goes from p by ``word``; parts it from q if needed."""
        if self.len[q] == self.len[p] + 1:
            return q
        clone = self._state(self.len[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = clone
        while p >= 0 and self.next[p].get(word) == q:
            self.next[p][word] = clone
            p = self.link[p]
        return clone

    def _extend(self, last: int, word: int) -> int:
        if word in self.next[last]:
            return self._split(last, self.next[last][word], word)
        new, p = self._state(self.len[last] + 1, 0, {}), last
        while p >= 0 and word not in self.next[p]:
            self.next[p][word] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self._split(p, self.next[p][word], word)
        return new


class Scanner:
    """Streams texts through the automaton of some phrases and templates."""

    def __init__(self, phrases=PHRASES, templates=TEMPLATES):
        self.phrases, self.templates = phrases, templates
        texts = [p.split() for p, _ in phrases] + [t.split() for _, t in templates]
        words = sorted({w for t in texts for w in t})
        number = {w: k for k, w in enumerate(words)}
        self.lengths = [len(t) for t in texts]
        self.automaton = Automaton([[number[w] for w in t] for t in texts])
        hashes = words_of([w.encode() for w in words], _BLANK)[0]
        order = np.argsort(hashes)
        self.hashes, self.numbers = hashes[order], order
        a = self.automaton
        #: Of each state the phrases that end there, which are suffixes of its strings.
        self.ending: list[tuple[int, ...]] = []
        for state in range(len(a.len)):
            here, s = [], state
            while s > 0:
                here += [
                    k for k in range(len(phrases)) if a.ends[s].get(k) == self.lengths[k] - 1 and a.len[a.link[s]] < self.lengths[k] <= a.len[s]
                ]
                s = a.link[s]
            self.ending.append(tuple(here))

    def scan(self, texts: list[bytes]):
        """Of each text (words, places of phrases [(word, phrase)], covered spans [(template, share, from, to)])."""
        hashes, _, _, first = words_of([t.lower() for t in texts], _BLANK)
        at = np.minimum(np.searchsorted(self.hashes, hashes), len(self.hashes) - 1)
        known = self.hashes[at] == hashes
        numbers = np.where(known, self.numbers[at], -1)
        # Stretches of known words; a single one can neither be a phrase nor a long match.
        edge = np.zeros(len(numbers) + 1, bool)
        edge[first] = True
        begin = known & (edge[:-1] | np.concatenate([[True], ~known[:-1]]))
        starts = np.flatnonzero(begin)
        stops = np.concatenate([starts[1:], [len(numbers)]])
        # each stretch ends at the first unknown word after its start
        unknown = np.flatnonzero(~known)
        where = np.searchsorted(unknown, starts)
        ends = np.where(where < len(unknown), unknown[np.minimum(where, max(len(unknown) - 1, 0))] if len(unknown) else len(numbers), len(numbers))
        ends = np.minimum(ends, stops)
        keep = ends - starts > 1
        starts, ends = starts[keep], ends[keep]
        owner = np.searchsorted(first, starts, side="right") - 1
        found = [(int(b - a), [], []) for a, b in zip(first[:-1], first[1:])]
        for k, i, j in zip(owner.tolist(), starts.tolist(), ends.tolist()):
            self._stream(numbers[i:j].tolist(), i - int(first[k]), found[k][1], found[k][2])
        return [(n, places, self._chains(matches)) for n, places, matches in found]

    def _stream(self, numbers: list[int], offset: int, places: list, matches: list) -> None:
        a, ending, lengths = self.automaton, self.ending, self.lengths
        state = length = 0
        for k, w in enumerate(numbers):
            before, was = state, length
            while state and w not in a.next[state]:
                state = a.link[state]
                length = a.len[state]
            if w in a.next[state]:
                state = a.next[state][w]
                length += 1
            else:
                length = 0
            if was >= 3 and length <= was:  # the match that ended before this word can't be made longer
                matches.append((offset + k - was, was, before))
            for p in ending[state]:
                if length >= lengths[p]:
                    places.append((offset + k - lengths[p] + 1, p))
        if length >= 3:
            matches.append((offset + len(numbers) - length, length, state))

    def _chains(self, matches: list[tuple[int, int, int]]) -> list[tuple[int, float, int, int]]:
        """Chains of matches (file word, length, state) by template."""
        by_template = defaultdict(list)
        for start, length, state in matches:
            for number, end in self.automaton.ends[state].items():
                t = number - len(self.phrases)
                if t >= 0 and length >= min(LONG, self.lengths[number]):
                    by_template[t].append((start, end - length + 1, length))
        out = []
        for t, parts in by_template.items():
            total = self.lengths[t + len(self.phrases)]
            best: list[tuple[int, int]] = []  # (covered words, where the chain starts in the file)
            for k, (x, y, n) in enumerate(parts):
                score = (n, x)
                for j in range(k - 1, -1, -1):
                    px, py, pn = parts[j]
                    if x - (px + pn) > GAP:
                        break  # matches are in order of the file
                    cut = max(0, px + pn - x, py + pn - y)
                    if y > py and x > px and abs((x - px) - (y - py)) <= GAP and y - (py + pn) <= GAP and cut < n:
                        score = max(score, (best[j][0] + n - cut, best[j][1]), key=lambda s: s[0])
                best.append(score)
            # The best chain, and all others that cover enough and don't overlap a better one.
            taken: list[tuple[int, int]] = []
            for k in sorted(range(len(parts)), key=lambda i: (-best[i][0], i)):
                if taken and best[k][0] < COVER * total:
                    break
                start, end = best[k][1], parts[k][0] + parts[k][2]
                if all(end <= i or j <= start for i, j in taken):
                    taken.append((start, end))
                    out.append((t, min(1.0, best[k][0] / total), start, end))
        return sorted(out)


def license_scan(docs: DataFrame, phrases=PHRASES, templates=TEMPLATES) -> DataFrame:
    """One row per row of ``docs``: doc_id, n_words, n_base, first_word, last_word, base_labels, labels, score, spans.

    Words are runs of digits, letters a-z and characters beyond ASCII, after A-Z are
    lower-cased. n_base counts the places where a phrase's words stand consecutively;
    first_word and last_word are their smallest and largest start, null without any.
    ``labels`` adds those of templates of which COVER is covered; ``spans`` has
    (label, share, from word, to word) of each template that is matched at all. Null and
    empty texts have no words, no labels and the score 0. Ids may be null or repeat;
    each row is scanned. An empty table gives an empty result.
    """

    def scanned(batches):
        scanner = Scanner(phrases, templates)
        for batch in batches:
            for run, texts in text_runs(batch):
                out = defaultdict(list)
                for n, places, chains in scanner.scan(texts):
                    starts = [at for at, _ in places]
                    base = {phrases[p][1] for _, p in places}
                    more = {templates[t][0] for t, share, _, _ in chains if share >= COVER}
                    out["n_words"].append(n)
                    out["n_base"].append(len(places))
                    out["first_word"].append(min(starts, default=None))
                    out["last_word"].append(max(starts, default=None))
                    out["base_labels"].append(",".join(sorted(base)))
                    out["labels"].append(",".join(sorted(base | more)))
                    out["score"].append(1.0 if base else max((share for _, share, _, _ in chains), default=0.0))
                    out["spans"].append([{"label": templates[t][0], "share": s, "start": i, "end": j} for t, s, i, j in chains])
                yield pa.RecordBatch.from_pydict(
                    {"doc_id": batch.column("doc_id").slice(run.start, run.stop - run.start)} | out, schema=_ARROW
                )

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(scanned, _SCHEMA)


_SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string,"
    " score double, spans array<struct<label:string,share:double,start:long,end:long>>"
)
_SPAN = pa.struct([("label", pa.string()), ("share", pa.float64()), ("start", pa.int64()), ("end", pa.int64())])
_ARROW = pa.schema(
    [(c, pa.int64()) for c in ("doc_id", "n_words", "n_base", "first_word", "last_word")]
    + [("base_labels", pa.string()), ("labels", pa.string()), ("score", pa.float64()), ("spans", pa.list_(_SPAN))]
)


def license_base(spark, sf_dir):
    """The columns of ``op6_licenses`` that don't depend on templates."""
    out = license_scan(common.read(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels")


LICENSE_BASE_SQL = r"""
WITH t AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+') AS w
  FROM documents
), p AS (
  SELECT doc_id, len(w)::BIGINT AS n_words,
         [i - 1 FOR i IN range(1, len(w)) IF w[i] = 'mit' AND w[i + 1] = 'license'] AS m,
         [i - 1 FOR i IN range(1, len(w)) IF w[i] = 'apache' AND w[i + 1] = 'license'] AS a,
         [i - 1 FOR i IN range(1, len(w) - 1) IF w[i] = 'general' AND w[i + 1] = 'public' AND w[i + 2] = 'license'] AS g
  FROM t
), q AS (SELECT *, list_concat(m, a, g) AS places FROM p)
SELECT doc_id, n_words, len(places)::BIGINT AS n_base, list_min(places) AS first_word, list_max(places) AS last_word,
       array_to_string(list_concat(CASE WHEN len(a) > 0 THEN ['apache'] ELSE [] END, CASE WHEN len(g) > 0 THEN ['gpl'] ELSE [] END,
                                   CASE WHEN len(m) > 0 THEN ['mit'] ELSE [] END), ',') AS base_labels
FROM q
"""


def op6_licenses(spark, sf_dir):
    return license_scan(common.read(spark, sf_dir, "documents")).drop("spans")
