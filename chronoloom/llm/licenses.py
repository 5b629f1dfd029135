"""Licence detection with ordered signature rules over words."""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame

from chronoloom.llm import arrowtext
from chronoloom.llm.tasks import tidy

PHRASES = {
    "gnu general public license": "gpl",
    "apache license": "apache",
    "cc by": "cc-by",
    "mit license": "mit",
}
"""Phrases that are reported wherever their words stand one after another."""


@dataclass(frozen=True)
class Rule:
    """A signature: a pattern over a text's words, lower case and one space apart, run only where all words of ``gate`` occur.

    A smaller ``priority`` wins. ``score`` says how sure a find is.
    """

    label: str
    gate: tuple[str, ...]
    pattern: str
    priority: int
    score: float


# Families: label, gate word of the name, pattern of the name, identifier words, address words. Written by hand.
_FAMILIES = [
    ("agpl-3.0", "affero", r"gnu affero general public license(?: agpl)?(?: as published by the free software foundation)?(?: either)?(?: version 3| v3)", r"agpl 3 0(?: only| or later)?", r"gnu org licenses agpl(?: 3 0)?"),
    ("agpl-1.0", "affero", r"affero general public license(?: version 1| v1)", r"agpl 1 0(?: only| or later)?", r"affero org oagpl"),
    ("lgpl-3.0", "lesser", r"gnu lesser general public license(?: lgpl)?(?: as published by the free software foundation)?(?: either)?(?: version 3| v3)", r"lgpl 3 0(?: only| or later)?", r"gnu org licenses lgpl 3 0"),
    ("lgpl-2.1", "lesser", r"gnu lesser general public license(?: lgpl)?(?: as published by the free software foundation)?(?: either)?(?: version 2 1| v2 1)", r"lgpl 2 1(?: only| or later)?", r"gnu org licenses(?: old licenses)? lgpl 2 1"),
    ("lgpl-2.0", "library", r"gnu library general public license(?: version 2| v2)?", r"lgpl 2 0(?: only| or later)?", r"gnu org licenses old licenses lgpl 2 0"),
    ("gpl-3.0", "general", r"gnu general public license(?: gpl)?(?: as published by the free software foundation)?(?: either)?(?: version 3| v3)(?: 0)?", r"gpl 3 0(?: only| or later)?", r"gnu org licenses gpl 3 0"),
    ("gpl-2.0", "general", r"gnu general public license(?: gpl)?(?: as published by the free software foundation)?(?: either)?(?: version 2| v2)(?: 0)?", r"gpl 2 0(?: only| or later)?", r"gnu org licenses(?: old licenses)? gpl 2 0"),
    ("gpl-1.0", "general", r"gnu general public license(?: gpl)?(?: version 1| v1)", r"gpl 1 0(?: only| or later)?", r"gnu org licenses old licenses gpl 1 0"),
    ("gfdl-1.3", "documentation", r"gnu free documentation license(?: version)? 1 3", r"gfdl 1 3(?: only| or later)?", r"gnu org licenses fdl 1 3"),
    ("gfdl", "documentation", r"gnu free documentation license", r"gfdl(?: 1 [12])?", r"gnu org licenses fdl"),
    ("apache-2.0", "apache", r"apache license(?: version)? 2(?: 0)?", r"apache 2 0", r"apache org licenses license 2 0"),
    ("apache-1.1", "apache", r"apache(?: software)? license(?: version)? 1 1", r"apache 1 1", r"apache org licenses license 1 1"),
    ("apache-1.0", "apache", r"apache(?: software)? license(?: version)? 1 0", r"apache 1 0", r"apache org licenses license 1 0"),
    ("mit", "mit", r"(?:the )?mit(?: expat)? licen[sc]e", r"mit", r"opensource org licenses? mit(?: license)?"),
    ("mit-0", "mit", r"mit no attribution(?: license)?", r"mit 0", r"opensource org licenses? mit 0"),
    ("x11", "x11", r"x11 licen[sc]e", r"x11", r"x org licenses"),
    ("isc", "isc", r"isc licen[sc]e", r"isc", r"opensource org licenses? isc(?: license)?"),
    ("bsd-2-clause", "freebsd", r"freebsd licen[sc]e", r"bsd 2 clause freebsd", r"freebsd org copyright"),
    ("bsd-2-clause", "bsd", r"(?:simplified bsd|bsd 2 clause|2 clause bsd) licen[sc]e", r"bsd 2 clause", r"opensource org licenses? bsd 2 clause"),
    ("bsd-3-clause", "bsd", r"(?:new bsd|modified bsd|revised bsd|bsd 3 clause|3 clause bsd) licen[sc]e", r"bsd 3 clause", r"opensource org licenses? bsd 3 clause"),
    ("bsd-4-clause", "bsd", r"(?:original bsd|bsd 4 clause|4 clause bsd) licen[sc]e", r"bsd 4 clause", r"spdx org licenses bsd 4 clause"),
    ("0bsd", "zero", r"(?:zero clause|bsd zero clause) (?:bsd )?licen[sc]e", r"0bsd", r"opensource org licenses? 0bsd"),
    ("bsd", "bsd", r"bsd(?: style)? licen[sc]e", r"bsd", r"opensource org licenses? bsd license(?: php)?"),
    ("mpl-2.0", "mozilla", r"mozilla public license(?: version| v)? 2(?: 0)?", r"mpl 2 0(?: no copyleft exception)?", r"mozilla org mpl 2 0"),
    ("mpl-1.1", "mozilla", r"mozilla public license(?: version| v)? 1 1", r"mpl 1 1", r"mozilla org mpl 1 1"),
    ("epl-2.0", "eclipse", r"eclipse public license(?: version| v)? 2(?: 0)?", r"epl 2 0", r"eclipse org (?:legal )?epl(?: v)?(?: 20| 2 0)"),
    ("epl-1.0", "eclipse", r"eclipse public license(?: version| v)? 1(?: 0)?", r"epl 1 0", r"eclipse org (?:legal )?epl v10"),
    ("cddl-1.0", "distribution", r"common development and distribution license(?: version)?(?: 1 0)?", r"cddl 1 0", r"opensource org licenses? cddl(?: 1 0)?"),
    ("cpl-1.0", "common", r"common public license(?: version)?(?: 1 0)?", r"cpl 1 0", r"opensource org licenses? cpl(?: 1 0)?"),
    ("eupl-1.2", "european", r"european union public licen[sc]e(?: v| version)? 1 2", r"eupl 1 2", r"joinup ec europa eu .{0,60}eupl"),
    ("eupl-1.1", "european", r"european union public licen[sc]e(?: v| version)? 1 1", r"eupl 1 1", r"ec europa eu idabc eupl"),
    ("artistic-2.0", "artistic", r"artistic license 2 0", r"artistic 2 0", r"perlfoundation org artistic license 2 0"),
    ("artistic-1.0", "artistic", r"artistic license", r"artistic 1 0(?: perl)?", r"opensource org licenses? artistic license(?: 1 0)?"),
    ("bsl-1.0", "boost", r"boost software license(?: version)?(?: 1 0)?", r"bsl 1 0", r"boost org license 1 0(?: txt)?"),
    ("zlib", "zlib", r"zlib(?: libpng)? licen[sc]e", r"zlib", r"opensource org licenses? zlib(?: license)?"),
    ("unlicense", "unlicense", r"the unlicense", r"unlicense", r"unlicense org"),
    ("wtfpl", "fuck", r"do what the fuck you want to public license", r"wtfpl", r"wtfpl net"),
    ("python-2.0", "python", r"python software foundation license", r"(?:python|psf) 2 0", r"docs python org .{0,20}license"),
    ("postgresql", "postgresql", r"postgresql licen[sc]e", r"postgresql", r"postgresql org about licence"),
    ("php-3.01", "php", r"php license(?: version)?(?: 3 01)?", r"php 3 01", r"php net license 3 01(?: txt)?"),
    ("ofl-1.1", "sil", r"sil open font license(?: version)?(?: 1 1)?", r"ofl 1 1", r"scripts sil org ofl"),
    ("ms-pl", "microsoft", r"microsoft public license", r"ms pl", r"opensource org licenses? ms pl"),
    ("ms-rl", "microsoft", r"microsoft reciprocal license", r"ms rl", r"opensource org licenses? ms rl"),
    ("upl-1.0", "universal", r"universal permissive license(?: version| v)?(?: 1 0)?", r"upl 1 0", r"oss oracle com licenses upl"),
    ("ncsa", "illinois", r"university of illinois(?: ncsa)? open source license", r"ncsa", r"opensource org licenses? ncsa"),
    ("odbl-1.0", "database", r"open (?:data commons open )?database license(?: version| v)?(?: 1 0)?", r"odbl 1 0", r"opendatacommons org licenses odbl"),
    ("odc-by-1.0", "commons", r"open data commons attribution license", r"odc by 1 0", r"opendatacommons org licenses by"),
    ("pddl-1.0", "dedication", r"public domain dedication and licen[sc]e", r"pddl 1 0", r"opendatacommons org licenses pddl"),
    ("bust-1.1", "business", r"business source license(?: 1 1)?", r"busl 1 1", r"mariadb com bsl11"),
    ("sspl-1.0", "server", r"server side public license(?: version| v)?(?: 1)?", r"sspl 1 0", r"mongodb com licensing server side public license"),
    ("elastic-2.0", "elastic", r"elastic license(?: version| v)?(?: 2 0)?", r"elastic 2 0", r"elastic co licensing elastic license"),
    ("openrail", "rail", r"(?:creativeml |bigscience )?open rail(?: m| s)?(?: licen[sc]e)?", r"(?:creativeml )?openrail(?: m)?", r"licenses ai"),
]

# Creative Commons: the parts of a licence, as words, each with every version.
_CC_PARTS = {
    "by": r"by",
    "by-sa": r"by sa",
    "by-nd": r"by nd",
    "by-nc": r"by nc",
    "by-nc-sa": r"by nc sa",
    "by-nc-nd": r"by nc nd",
}
_CC_WORDS = {"by": "attribution", "sa": "share ?alike", "nd": "no ?deriv(?:ative)?s?(?: works)?", "nc": "non ?commercial"}
_CC_VERSIONS = ["4.0", "3.0", "2.5", "2.0", "1.0"]

_GENERAL = [
    Rule("gpl", ("general", "public"), r"gnu general public licen[sc]e", 60, 0.8),
    Rule("lgpl", ("lesser",), r"gnu lesser general public licen[sc]e", 58, 0.8),
    Rule("agpl", ("affero",), r"gnu affero general public licen[sc]e", 58, 0.8),
    Rule("apache", ("apache",), r"apache(?: software)? licen[sc]e", 60, 0.8),
    Rule("mpl", ("mozilla",), r"mozilla public licen[sc]e", 60, 0.8),
    Rule("epl", ("eclipse",), r"eclipse public licen[sc]e", 60, 0.8),
    Rule("cc", ("creative", "commons"), r"creative commons(?: licen[sc]e)?", 70, 0.6),
    Rule("cc0-1.0", ("cc0",), r"cc0(?: 1 0)?(?: universal)?", 50, 0.9),
    Rule("cc0-1.0", ("publicdomain",), r"creativecommons org publicdomain zero 1 0", 20, 0.95),
    Rule("public-domain", ("domain",), r"(?:released|dedicated|placed) (?:in|into|to) the public domain", 40, 0.85),
    Rule("proprietary", ("reserved",), r"all rights reserved", 80, 0.4),
    Rule("proprietary", ("confidential",), r"(?:proprietary and confidential|confidential and proprietary)", 75, 0.6),
    Rule("permissive-text", ("granted", "charge"), r"permission is hereby granted free of charge to any person obtaining a copy", 30, 0.95),
    Rule("bsd-text", ("redistribution",), r"redistribution and use in source and binary forms with or without modification are permitted", 30, 0.95),
    Rule("isc-text", ("fee",), r"permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", 30, 0.95),
    Rule("warranty-disclaimer", ("warranty",), r"(?:provided )?(?:as is )?without warranty of any kind", 90, 0.3),
]


def signature_rules() -> list[Rule]:
    """All rules in order of priority: for each family an identifier, an address, a grant and a title, then Creative Commons, then general ones."""
    rules = []
    grant = r"(?:licen[sc]ed|released|distributed|available|published|provided)(?: to you)? under (?:the )?(?:terms of )?(?:the )?"
    for label, gate, name, identifier, address in _FAMILIES:
        key = identifier.split(" ")[0].split("(")[0]
        rules.append(Rule(label, ("spdx",), rf"spdx license identifier {identifier}", 10, 1.0))
        rules.append(Rule(label, (gate, "under"), grant + name, 30, 0.95))
        rules.append(Rule(label, (gate,), name, 50, 0.9))
        host = address.split(" ")[0].split("(")[0]
        rules.append(Rule(label, (host,), rf"(?:https? )?(?:www )?{address}", 20, 0.95))
        if key not in ("", "the", gate) and " " in identifier:
            rules.append(Rule(label, (key,), rf"licen[sc]e {identifier}", 55, 0.85))
    for parts, short in _CC_PARTS.items():
        words = " ".join(_CC_WORDS[p] for p in parts.split("-"))
        for version in _CC_VERSIONS:
            number = version.replace(".", " ")
            label = f"cc-{parts}-{version}"
            rules.append(Rule(label, ("spdx",), rf"spdx license identifier cc {short} {number}", 10, 1.0))
            rules.append(Rule(label, ("creativecommons",), rf"creativecommons org licenses {short} {number}", 20, 0.95))
            rules.append(Rule(label, ("cc",), rf"cc {short} {number}", 35, 0.95))
            rules.append(Rule(label, ("creative", "commons"), rf"creative commons {words}(?: international| unported| generic)?(?: license)?(?: version)? {number}", 35, 0.95))
        rules.append(Rule(f"cc-{parts}", ("cc",), rf"cc {short}", 62, 0.8))
        rules.append(Rule(f"cc-{parts}", ("creative", "commons"), rf"creative commons {words}", 62, 0.8))
    return sorted(rules + _GENERAL, key=lambda r: r.priority)


@dataclass(frozen=True)
class Find:
    """A detection: the rule's label, its words from ``start`` up to but not including ``end``, its rank among the rules and its score."""

    label: str
    start: int
    end: int
    rank: int
    score: float


class _Kept:
    """Finds that stay so far, asked for containment in steps that grow with the logarithm of the text.

    A tree over the words keeps the farthest end of the finds that start at or before a word. A find that goes lies within the one that
    replaces it, so its entry in the tree never says more than that one's.
    """

    def __init__(self, n_words: int) -> None:
        self.ends = [0] * (n_words + 1)
        self.by_start: dict[int, list[Find]] = {}

    def holds(self, new: Find) -> bool:
        """Whether some find contains the new one."""
        at = new.start + 1
        while at > 0:
            if self.ends[at] >= new.end:
                return True
            at &= at - 1
        return False

    def add(self, new: Find) -> None:
        """Keep a find; those within it that it is a version of go."""
        for start in range(new.start, new.end):
            if start in self.by_start:
                self.by_start[start] = [k for k in self.by_start[start] if k.end > new.end or not new.label.startswith(k.label + "-")]
        self.by_start.setdefault(new.start, []).append(new)
        at = new.start + 1
        while at < len(self.ends):
            self.ends[at] = max(self.ends[at], new.end)
            at += at & -at


class Detector:
    """Rules compiled, with the hashes of their gate words."""

    def __init__(self, rules: list[Rule]) -> None:
        self.rules = [(rank, rule, re.compile(rf"(?<![^ ]){rule.pattern}(?![^ ])")) for rank, rule in enumerate(rules)]
        gates = sorted({w for r in rules for w in r.gate})
        hashes = np.array([arrowtext.word_hash(w) for w in gates], dtype=np.uint64)
        order = np.argsort(hashes)
        self.hashes, self.gates = hashes[order], [gates[i] for i in order]
        self.quick = np.zeros(1 << 16, dtype=bool)
        self.quick[(self.hashes & np.uint64(0xFFFF)).astype(np.int64)] = True
        self.phrases = [(label, [arrowtext.word_hash(w) for w in phrase.split()]) for phrase, label in PHRASES.items()]

    def gated(self, found: arrowtext.Words) -> dict[int, set[str]]:
        """Rows that hold gate words, with those words."""
        maybe = np.flatnonzero(self.quick[(found.hash & np.uint64(0xFFFF)).astype(np.int64)])
        at = np.minimum(np.searchsorted(self.hashes, found.hash[maybe]), len(self.hashes) - 1)
        sure = self.hashes[at] == found.hash[maybe]
        out: dict[int, set[str]] = {}
        rows = np.searchsorted(found.first, maybe[sure], "right") - 1
        pairs = np.unique(rows * len(self.gates) + at[sure])
        for pair in pairs.tolist():
            out.setdefault(pair // len(self.gates), set()).add(self.gates[pair % len(self.gates)])
        return out

    def phrase_places(self, found: arrowtext.Words) -> list[tuple[str, np.ndarray]]:
        """For each phrase its label and the word numbers, over the whole batch, at which its words stand one after another in one row."""
        out = []
        for label, hashes in self.phrases:
            at = np.flatnonzero(found.hash == np.uint64(hashes[0]))
            at = at[at + len(hashes) <= len(found.hash)]
            for k, h in enumerate(hashes[1:], 1):
                at = at[found.hash[at + k] == np.uint64(h)]
            row = np.searchsorted(found.first, at, "right")
            out.append((label, at[at + len(hashes) <= found.first[row]] if len(at) else at))
        return out

    def finds(self, words: list[str], gates: set[str]) -> list[Find]:
        """Detections in a text's words that are left after suppression.

        Rules are tried in order of priority. A find inside the words of another goes if the other's rule ranks at least as high, or if the other is longer and
        its label is a version of the same family (``gpl`` in ``gpl-3.0``). Finds that overlap without containment both stay.
        """
        text = " ".join(words)
        starts = np.cumsum([0] + [len(w) + 1 for w in words])
        kept = _Kept(len(words))
        for rank, rule, pattern in self.rules:
            if not gates.issuperset(rule.gate):
                continue
            for hit in pattern.finditer(text):
                start = int(np.searchsorted(starts, hit.start()))
                new = Find(rule.label, start, int(np.searchsorted(starts, hit.end())), rank, rule.score)
                if not kept.holds(new):
                    kept.add(new)
        return sorted((f for own in kept.by_start.values() for f in own), key=lambda f: (f.start, f.end, f.rank))


_FINDS = pa.list_(pa.struct([("label", pa.string()), ("start", pa.int64()), ("end", pa.int64()), ("text", pa.string()), ("score", pa.float64())]))
SCHEMA = (
    "doc_id long, n_words long, n_base long, first_word long, last_word long, base_labels string, labels string, score double, "
    "finds array<struct<label:string,start:long,end:long,text:string,score:double>>"
)


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    detector = Detector(signature_rules())
    word = re.compile(rb"[0-9a-z\x80-\xff]+")
    for batch in arrowtext.slices(batches, "text"):
        data, offsets = arrowtext.text_bytes(batch.column("text"))
        found = arrowtext.words(data, offsets, arrowtext.ALNUM, arrowtext.LOWER)
        rows = batch.num_rows
        n_base, first, last = np.zeros(rows, dtype=np.int64), np.full(rows, -1, dtype=np.int64), np.full(rows, -1, dtype=np.int64)
        base: dict[int, set[str]] = {}
        for label, at in detector.phrase_places(found):
            row = np.searchsorted(found.first, at, "right") - 1
            np.add.at(n_base, row, 1)
            for r, place in zip(row.tolist(), (at - found.first[row]).tolist()):
                base.setdefault(r, set()).add(label)
                first[r] = place if first[r] < 0 else min(first[r], place)
                last[r] = max(last[r], place)
        finds: list[list[dict]] = [[] for _ in range(rows)]
        for r, gates in detector.gated(found).items():
            own = [w.decode() for w in word.findall(arrowtext.LOWER[data[offsets[r] : offsets[r + 1]]].tobytes())]
            finds[r] = [
                {"label": f.label, "start": f.start, "end": f.end, "text": " ".join(own[f.start : f.end]), "score": f.score} for f in detector.finds(own, gates)
            ]
        labels = [base.get(r, set()) | {f["label"] for f in finds[r]} for r in range(rows)]
        score = [max([0.8 if r in base else 0.0, *(f["score"] for f in finds[r])]) for r in range(rows)]
        yield pa.RecordBatch.from_arrays(
            [
                batch.column("doc_id"),
                pa.array(np.diff(found.first)),
                pa.array(n_base),
                pa.array(first, mask=first < 0),
                pa.array(last, mask=last < 0),
                pa.array([",".join(sorted(base.get(r, ()))) for r in range(rows)]),
                pa.array([",".join(sorted(x)) for x in labels]),
                pa.array(score, pa.float64()),
                pa.array(finds, _FINDS),
            ],
            names=["doc_id", "n_words", "n_base", "first_word", "last_word", "base_labels", "labels", "score", "finds"],
        )


def scan_licenses(docs: DataFrame) -> DataFrame:
    """Licences found in every row of ``docs(doc_id, text)``.

    Words are runs of digits, letters and characters beyond ASCII, A to Z lower-cased; words, places and spans are numbered from 0 in a text. Columns: doc_id, n_words,
    n_base (places of PHRASES), first_word and last_word (their first and last start, null without any), base_labels, labels (with those of the rules;
    both sorted and joined by commas), score (the surest find, 0 without any), finds (label, start, end, text, score of each detection that is left
    after suppression).

    Null and empty texts have no words and empty labels. Long texts are read whole; repeated rows each get their row; other columns are ignored.
    """
    return docs.select("doc_id", "text").mapInArrow(tidy(_scan), SCHEMA)
