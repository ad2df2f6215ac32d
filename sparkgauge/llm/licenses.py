"""Licence scan by sentence rules.

A text is cut into sentences, which are normalised (lower case, words and version numbers
only, names and years of copyright holders taken out; usual subjects, verbs and holders made
one) and looked up among known licence sentences. The identifiers found, in text order, are matched against rules: ordered
sequences of identifiers that stand for a licence. Longer rules win over shorter ones that
begin at the same sentence; matched sentences are used up. Sentences that are known but
belong to no matched rule are reported as such, so nothing found is dropped.

Defined results
  - null or empty texts, and texts without a known sentence, have empty lists;
  - a sentence that ends at a line break, a full stop before white space, or the end of the
    text counts the same; repeated sentences count each time;
  - other text between the sentences of a rule breaks the rule only if it holds a known
    sentence of another kind;
  - repeated rows and null ids give one row each; empty tables give an empty result; other
    columns are ignored, whatever their names.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame

# Sentences of public licence notices, by identifier.
SENTENCES = {
    "apache-2.0-short": "licensed under the apache license version 2.0",
    "apache-2.0-grant": "licensed under the apache license version 2.0 the license",
    "apache-2.0-use": "you may not use this file except in compliance with the license",
    "apache-2.0-copy": "you may obtain a copy of the license at",
    "apache-2.0-as-is": "unless required by applicable law or agreed to in writing software distributed under the license is "
    "distributed on an as is basis without warranties or conditions of any kind either express or implied",
    "apache-2.0-see": "see the license for the specific language governing permissions and limitations under the license",
    "mit-short": "released under the mit license",
    "mit-name": "the mit license mit",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the rights to "
    "use copy modify merge publish distribute sublicense and/or sell copies of the software and to permit persons to whom the "
    "software is furnished to do so subject to the following conditions",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial "
    "portions of the software",
    "gpl-3.0-short": "this work is licensed under the gnu general public license version 3",
    "gpl-grant": "this program is free software you can redistribute it and/or modify it under the terms of the gnu general "
    "public license as published by the free software foundation either version 3 of the license or at your option any later "
    "version",
    "gpl-2-grant": "this program is free software you can redistribute it and/or modify it under the terms of the gnu general "
    "public license as published by the free software foundation either version 2 of the license or at your option any later "
    "version",
    "gpl-warranty": "this program is distributed in the hope that it will be useful but without any warranty without even the "
    "implied warranty of merchantability or fitness for a particular purpose",
    "gpl-see": "see the gnu general public license for more details",
    "bsd-grant": "redistribution and use in source and binary forms with or without modification are permitted provided that "
    "the following conditions are met",
    "bsd-source": "redistributions of source code must retain the above copyright notice this list of conditions and the "
    "following disclaimer",
    "bsd-binary": "redistributions in binary form must reproduce the above copyright notice this list of conditions and the "
    "following disclaimer in the documentation and/or other materials provided with the distribution",
    "bsd-neither": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission",
    "bsd-disclaimer": "this software is provided by the copyright holders and contributors as is and any express or implied "
    "warranties including but not limited to the implied warranties of merchantability and fitness for a particular purpose are disclaimed",
    "bsd-liability": "in no event shall the copyright holder or contributors be liable for any direct indirect incidental special "
    "exemplary or consequential damages including but not limited to procurement of substitute goods or services loss of use data or "
    "profits or business interruption however caused and on any theory of liability whether in contract strict liability or tort "
    "including negligence or otherwise arising in any way out of the use of this software even if advised of the possibility of such damage",
    "mit-disclaimer": "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement",
    "mit-liability": "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in "
    "an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
    "isc-disclaimer": "the software is provided as is and the author disclaims all warranties with regard to this software including all "
    "implied warranties of merchantability and fitness",
    "isc-liability": "in no event shall the author be liable for any special direct indirect or consequential damages or any damages "
    "whatsoever resulting from loss of use data or profits whether in an action of contract negligence or other tortious action arising "
    "out of or in connection with the use or performance of this software",
    "lgpl-see": "see the gnu lesser general public license for more details",
    "agpl-see": "see the gnu affero general public license for more details",
    "mpl-2.0-copy": "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla.org/mpl/2.0",
    "epl-2.0-grant": "this program and the accompanying materials are made available under the terms of the eclipse public license 2.0 "
    "which is available at",
    "epl-1.0-grant": "all rights reserved this program and the accompanying materials are made available under the terms of the eclipse "
    "public license v1.0 which accompanies this distribution and is available at",
    "unlicense-grant": "this is free and unencumbered software released into the public domain",
    "unlicense-use": "anyone is free to copy modify publish use compile sell or distribute this software either in source code form or "
    "as a compiled binary for any purpose commercial or non-commercial and by any means",
    "isc-grant": "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby "
    "granted provided that the above copyright notice and this permission notice appear in all copies",
    "mpl-2.0-grant": "this source code form is subject to the terms of the mozilla public license v 2.0",
    "cc-by-nc-4.0-short": "licensed under cc by-nc 4.0",
    "cc-by-4.0-short": "licensed under cc by 4.0",
    "cc-by-sa-4.0-short": "licensed under cc by-sa 4.0",
    "cc0-short": "this work is dedicated to the public domain under cc0 1.0",
}
# GNU notices differ by family and version only.
for _key, _family in (("lgpl", "lesser general"), ("agpl", "affero general")):
    for _v in ("2.1", "3"):
        if (_key, _v) != ("agpl", "2.1"):
            _tail = f"under the terms of the gnu {_family} public license as published by the free software foundation"
            SENTENCES[f"{_key}-{_v}-grant"] = (
                f"this program is free software you can redistribute it and/or modify it {_tail} either version {_v} of the license "
                "or at your option any later version"
            )
            SENTENCES[f"{_key}-{_v}-only-grant"] = f"this program is free software you can redistribute it and/or modify it {_tail} version {_v} of the license"
# Names after "licensed under": SPDX identifier by the wordings of a short notice.
SHORT_NAMES = {
    "MIT": "mit license|mit",
    "Apache-2.0": "apache license 2.0|apache-2.0|apache-2.0 license|apache 2.0 license",
    "BSD-2-Clause": "bsd 2-clause license|bsd-2-clause|bsd-2-clause license|2-clause bsd license",
    "BSD-3-Clause": "bsd 3-clause license|bsd-3-clause|bsd-3-clause license|3-clause bsd license",
    "ISC": "isc license|isc",
    "MPL-2.0": "mozilla public license version 2.0|mozilla public license 2.0|mpl-2.0|mpl 2.0",
    "EPL-1.0": "eclipse public license version 1.0|eclipse public license 1.0|epl-1.0",
    "EPL-2.0": "eclipse public license version 2.0|eclipse public license 2.0|eclipse public license v2.0|epl-2.0",
    "Unlicense": "unlicense",
    "GPL-2.0-only": "gnu general public license version 2|gpl-2.0-only",
    "GPL-3.0-only": "gpl-3.0-only",
    "LGPL-2.1-only": "gnu lesser general public license version 2.1|lgpl-2.1-only",
    "LGPL-3.0-only": "gnu lesser general public license version 3|lgpl-3.0-only",
    "AGPL-3.0-only": "gnu affero general public license version 3|agpl-3.0-only",
    "CC-BY-4.0": "cc-by-4.0|creative commons attribution 4.0 international license",
    "CC-BY-SA-4.0": "cc-by-sa-4.0|creative commons attribution-sharealike 4.0 international license",
    "CC-BY-NC-4.0": "cc-by-nc-4.0|creative commons attribution-noncommercial 4.0 international license",
    "CC-BY-ND-4.0": "cc by-nd 4.0|cc-by-nd-4.0|creative commons attribution-noderivatives 4.0 international license",
    "CC-BY-NC-SA-4.0": "cc by-nc-sa 4.0|cc-by-nc-sa-4.0|creative commons attribution-noncommercial-sharealike 4.0 international license",
    "CC-BY-NC-ND-4.0": "cc by-nc-nd 4.0|cc-by-nc-nd-4.0|creative commons attribution-noncommercial-noderivatives 4.0 international license",
}
# Rules as ordered identifiers and the licence they stand for.
RULES = {
    ("apache-2.0-grant", "apache-2.0-use", "apache-2.0-copy", "apache-2.0-as-is", "apache-2.0-see"): "Apache-2.0",
    ("apache-2.0-grant", "apache-2.0-use"): "Apache-2.0",
    ("apache-2.0-short",): "Apache-2.0",
    ("mit-name", "mit-grant", "mit-notice"): "MIT",
    ("mit-grant", "mit-notice"): "MIT",
    ("mit-short",): "MIT",
    ("gpl-grant", "gpl-warranty", "gpl-see"): "GPL-3.0-or-later",
    ("gpl-grant",): "GPL-3.0-or-later",
    ("gpl-2-grant", "gpl-warranty", "gpl-see"): "GPL-2.0-or-later",
    ("gpl-2-grant",): "GPL-2.0-or-later",
    ("gpl-3.0-short",): "GPL-3.0-only",
    ("bsd-grant", "bsd-source", "bsd-binary"): "BSD-2-Clause",
    ("isc-grant",): "ISC",
    ("mpl-2.0-grant",): "MPL-2.0",
    ("cc-by-nc-4.0-short",): "CC-BY-NC-4.0",
    ("cc-by-4.0-short",): "CC-BY-4.0",
    ("cc-by-sa-4.0-short",): "CC-BY-SA-4.0",
    ("cc0-short",): "CC0-1.0",
    ("mit-name", "mit-grant", "mit-notice", "mit-disclaimer", "mit-liability"): "MIT",
    ("mit-grant", "mit-notice", "mit-disclaimer", "mit-liability"): "MIT",
    ("bsd-grant", "bsd-source", "bsd-binary", "bsd-disclaimer", "bsd-liability"): "BSD-2-Clause",
    ("bsd-grant", "bsd-source", "bsd-binary", "bsd-neither"): "BSD-3-Clause",
    ("bsd-grant", "bsd-source", "bsd-binary", "bsd-neither", "bsd-disclaimer", "bsd-liability"): "BSD-3-Clause",
    ("isc-grant", "isc-disclaimer", "isc-liability"): "ISC",
    ("mpl-2.0-grant", "mpl-2.0-copy"): "MPL-2.0",
    ("epl-1.0-grant",): "EPL-1.0",
    ("epl-2.0-grant",): "EPL-2.0",
    ("unlicense-grant", "unlicense-use"): "Unlicense",
    ("unlicense-grant",): "Unlicense",
}
for _key, _v, _name in (("lgpl", "2.1", "LGPL-2.1"), ("lgpl", "3", "LGPL-3.0"), ("agpl", "3", "AGPL-3.0")):
    for _grant, _end in (("grant", "or-later"), ("only-grant", "only")):
        for _rest in ((), ("gpl-warranty", f"{_key}-see")):
            RULES[(f"{_key}-{_v}-{_grant}", *_rest)] = f"{_name}-{_end}"
for _name, _wordings in SHORT_NAMES.items():
    for _i, _wording in enumerate(_wordings.split("|")):
        _id = f"{_name.lower()}-named" + (f"-{_i}" if _i else "")
        SENTENCES[_id] = f"licensed under the {_wording}"
        RULES[(_id,)] = _name
_BREAK = re.compile(r"(?<=[.!?:;])\s+|\n+")
_TOKEN = re.compile(r"[a-z0-9]+(?:[./-][a-z0-9]+)*")
_HOLDER = re.compile(r"^copyright\b.*")

# What a notice is about, and the verbs that mean the same; both are made one on either side of the comparison.
_SUBJECT = re.compile(
    r"^(?:(?:this|the) )?(?:(?:project|software|work|file|code|source code|program|library|package|repository|document|text|content|module) )?"
    r"(?:is |are )?(?:(?:released|licensed|distributed|available|made available|published) under|licensed under the terms of)(?: the terms of)?(?: (?:the|a))? "
)
# Beginnings of these count as well: lines may break anywhere in them.
_PROGRAM = re.compile(
    r"^(?:(?:this|the) )?[a-z0-9]+(?= is free software\b| is distributed in the hope\b|(?: is(?: free| distributed(?: in(?: the)?)?)?)?$)"
)
_NEITHER = re.compile(r"^neither the names? of .+? nor the names of (?:its|the|their) (?:contributors|authors) may be used")
_PROVIDER = re.compile(r"^this software is provided by .+? as is and any express")


_SUFFIX = re.compile(r"^(licensed under the .+?) see (?:the )?\S+ (?:file )?for (?:more |the full )?(?:details|information|text)$")
# Beginnings whose wording is made one only when the sentence has come to its closing words.
_OPEN = re.compile(r"^(?:neither the names? of\b|this software is provided by\b|(?:this|the) [a-z]+(?: code)? is (?:released|licensed|distributed(?! in the hope\b)|available|made)\b)")
OPEN_PIECES = 8  # More pieces than such a beginning or closing has words.
_CLOSING = re.compile(r"\bmay be used\b|\bas is and any express\b|\bunder\b")
_ASCII_LOWER = {c: c + 32 for c in range(ord("A"), ord("Z") + 1)}


def _alike(words: str) -> str:
    words = _SUFFIX.sub(r"\1", _SUBJECT.sub("licensed under the ", words))
    words = _PROGRAM.sub("this program", words)
    words = _NEITHER.sub("neither the name of the copyright holder nor the names of its contributors may be used", words)
    return _PROVIDER.sub("this software is provided by the copyright holders and contributors as is and any express", words)


SENTENCES = {name: _alike(text) for name, text in SENTENCES.items()}
_BY_TEXT = {text: name for name, text in reversed(SENTENCES.items())}
# First two words of the known sentences; a text without any of them is not cut at all.
_STARTS = sorted({" ".join(t.split()[:2]) for t in _BY_TEXT})
_ANY_START = re.compile(r"\b(?:released|distributed|available|published)\W+under\b|\bis\W+free\W+software\b|" + "|".join(r"\b" + re.escape(a) + r"\W+" + re.escape(b) + r"\b" for a, b in (s.split() for s in _STARTS)))
_PREFIXES = {" ".join(t.split()[:k]) for t in _BY_TEXT for k in range(1, len(t.split()) + 1)}


def normalise(sentence: str) -> str:
    """Lower-case words and numbers, single spaces; empty for a copyright holder's line."""
    words = " ".join(_TOKEN.findall(sentence.lower()))
    return "" if _HOLDER.match(words) else words


def sentence_ids(text: str | None) -> list[tuple[int, str]]:
    """Known licence sentences of a text as (offset, identifier), in order.

    A sentence may run over several lines or contain marks that end others (colons, commas,
    numbers of list items), so pieces are put together as long as they begin a known one.
    """
    if not text:
        return []
    # Offsets are the text's own: only A-Z change here, and nothing changes its length.
    low = text.translate(_ASCII_LOWER)
    if not _ANY_START.search(low):
        return []
    pieces, at = [], 0
    for cut in _BREAK.finditer(low):
        pieces.append((at, normalise(low[at : cut.start()])))
        at = cut.end()
    pieces.append((at, normalise(low[at:])))
    pieces = [(o, re.sub(r"^(?:\d+|[a-z])\s+(?=redistributions|neither)", "", p)) for o, p in pieces if p]
    found, i = [], 0
    while i < len(pieces):
        parts, best, closed = [], None, False
        for k in range(i, len(pieces)):
            if k > i and not closed and _OPEN.match(pieces[k][1]):
                break
            parts.append(pieces[k][1])
            # A holder's name may be of any length: nothing is compared before the closing words.
            if not closed and _OPEN.match(" ".join(parts[:OPEN_PIECES])):
                closed = bool(_CLOSING.search(" ".join(parts[-OPEN_PIECES:])))
                if not closed:
                    continue
            known = _alike(" ".join(parts))
            if known in _BY_TEXT:
                best = (k, _BY_TEXT[known])
            if known not in _PREFIXES:
                break
        if best:
            found.append((pieces[i][0], best[1]))
            i = best[0] + 1
        else:
            i += 1
    return found


def match_rules(ids: list[str]) -> tuple[list[str], list[str]]:
    """Licences of the matched rules in text order, and the identifiers no rule used."""
    licences, loose, i = [], [], 0
    while i < len(ids):
        rule = max((r for r in RULES if tuple(ids[i : i + len(r)]) == r), key=len, default=None)
        if rule:
            licences.append(RULES[rule])
            i += len(rule)
        else:
            loose.append(ids[i])
            i += 1
    return licences, loose


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    strings = pa.list_(pa.string())
    for batch in batches:
        ids, offsets, licences, loose = [], [], [], []
        for text in batch.column(1):
            found = sentence_ids(text.as_py())
            names = [name for _, name in found]
            matched, rest = match_rules(names)
            ids.append(names)
            offsets.append([o for o, _ in found])
            licences.append(matched)
            loose.append(rest)
        yield pa.RecordBatch.from_arrays(
            [batch.column(0), pa.array(ids, strings), pa.array(offsets, pa.list_(pa.int64())), pa.array(licences, strings), pa.array(loose, strings)],
            names=["doc_id", "sentences", "offsets", "licenses", "unmatched"],
        )


def scan_licenses(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Per document: doc_id, sentences (identifiers in order), offsets, licenses, unmatched."""
    return docs.selectExpr(f"`{id_col}` AS doc_id", f"`{text_col}` AS text").mapInArrow(
        _scan,
        f"doc_id {docs.schema[id_col].dataType.simpleString()}, sentences array<string>, offsets array<bigint>, "
        "licenses array<string>, unmatched array<string>",
    )
