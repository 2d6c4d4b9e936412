"""Licence texts recognised by a canonical digest.

Two texts that differ only in case, punctuation, white space, copyright lines or equivalent spellings
get one canonical form; its SHA-256 is looked up among the digests of known licence texts by a hash
join.  Everything is a JVM expression; no text is shuffled.
"""

from __future__ import annotations

from functools import reduce
from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# Spellings that licence comparison treats as equal, as (variant, kept) words.
SPELLINGS = [
    ("acknowledgement", "acknowledgment"),
    ("analogue", "analog"),
    ("analyse", "analyze"),
    ("artefact", "artifact"),
    ("authorisation", "authorization"),
    ("authorised", "authorized"),
    ("calibre", "caliber"),
    ("cancelled", "canceled"),
    ("capitalisations", "capitalizations"),
    ("catalogue", "catalog"),
    ("categorise", "categorize"),
    ("centre", "center"),
    ("copyright holder", "copyright owner"),
    ("emphasised", "emphasized"),
    ("favour", "favor"),
    ("favourite", "favorite"),
    ("fulfil", "fulfill"),
    ("fulfilment", "fulfillment"),
    ("https", "http"),
    ("initialise", "initialize"),
    ("judgement", "judgment"),
    ("labelling", "labeling"),
    ("labour", "labor"),
    ("licence", "license"),
    ("maximise", "maximize"),
    ("modelled", "modeled"),
    ("modelling", "modeling"),
    ("non commercial", "noncommercial"),
    ("offence", "offense"),
    ("optimise", "optimize"),
    ("organisation", "organization"),
    ("organise", "organize"),
    ("percent", "per cent"),
    ("practise", "practice"),
    ("programme", "program"),
    ("realise", "realize"),
    ("recognise", "recognize"),
    ("signalling", "signaling"),
    ("sub license", "sublicense"),
    ("utilisation", "utilization"),
    ("whilst", "while"),
    ("wilful", "willful"),
]

# Short licence notices and texts, whole, by identifier.
KNOWN = [
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("MIT", "Released under the MIT License."),
    ("MIT", """Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:

The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.

THE SOFTWARE IS PROVIDED "AS IS", WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR OTHER DEALINGS IN THE SOFTWARE."""),
    ("ISC", """Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee is hereby granted, provided that the above copyright notice and this permission notice appear in all copies.

THE SOFTWARE IS PROVIDED "AS IS" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS SOFTWARE."""),
]

_BSD = """Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:

1. Redistributions of source code must retain the above copyright notice, this list of conditions and the following disclaimer.

2. Redistributions in binary form must reproduce the above copyright notice, this list of conditions and the following disclaimer in the documentation and/or other materials provided with the distribution.
%s
THIS SOFTWARE IS PROVIDED BY THE COPYRIGHT HOLDERS AND CONTRIBUTORS "AS IS" AND ANY EXPRESS OR IMPLIED WARRANTIES, INCLUDING, BUT NOT LIMITED TO, THE IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS FOR A PARTICULAR PURPOSE ARE DISCLAIMED. IN NO EVENT SHALL THE COPYRIGHT HOLDER OR CONTRIBUTORS BE LIABLE FOR ANY DIRECT, INDIRECT, INCIDENTAL, SPECIAL, EXEMPLARY, OR CONSEQUENTIAL DAMAGES (INCLUDING, BUT NOT LIMITED TO, PROCUREMENT OF SUBSTITUTE GOODS OR SERVICES; LOSS OF USE, DATA, OR PROFITS; OR BUSINESS INTERRUPTION) HOWEVER CAUSED AND ON ANY THEORY OF LIABILITY, WHETHER IN CONTRACT, STRICT LIABILITY, OR TORT (INCLUDING NEGLIGENCE OR OTHERWISE) ARISING IN ANY WAY OUT OF THE USE OF THIS SOFTWARE, EVEN IF ADVISED OF THE POSSIBILITY OF SUCH DAMAGE."""

# Longer texts; "All rights reserved." may be a line of its own after the notice.
LONGER = [
    (name, opening + text)
    for opening in ("", "All rights reserved.\n\n")
    for name, text in [
        ("BSD-2-Clause", _BSD % ""),
        ("BSD-3-Clause", _BSD % "\n3. Neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission.\n"),
    ]
]


def all_known() -> list[tuple[str, str]]:
    """Every known text: those above and the whole licences in ``license_texts``, named by identifier."""
    whole = sorted(Path(__file__).with_name("license_texts").glob("*.txt"))
    return KNOWN + LONGER + [(p.stem, p.read_text(encoding="utf-8")) for p in whole]


# A notice line: it opens with a copyright sign, or with the word and has a sign or "by" next or a year further on.  Other
# lines that open with the word are text, wrapped there.
_NOTICE_LINE = r"(^|\n)[^a-z0-9\n]*(©|copyright[^a-z0-9\n]*(©|\(c\)|by[^a-z0-9]|([^\n]*[^a-z0-9\n])?(19|20)[0-9]{2}([^a-z0-9]|$)))[^\n]*"
# The SQL answer's wider pattern: any line that opens with the word.
_NOTICE = r"(^|\n)[^a-z0-9\n]*(copyright|©)[^a-z\n]*( ?(c|by)[^a-z\n]+)?[^\n]*"


def canonical(text: Column) -> Column:
    """The canonical form: words of [a-z0-9] and letters beyond ASCII, single spaces between.

    A-Z are lower-cased, copyright notices fall away with their lines, what is neither
    letter nor digit becomes a space, and the spellings above are made equal.
    """
    upper, lower = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
    low = F.translate(F.coalesce(text, F.lit("")), upper, lower)
    plain = F.regexp_replace(F.regexp_replace(low, _NOTICE_LINE, "\n"), r"[\x00-/:-`{-\x7f©®™“”‘’–—]+", " ")
    words = F.concat(F.lit(" "), plain, F.lit(" "))
    # Every word is wanted with a space at either side of its own, so that neighbours are both found.
    spaced = F.replace(words, F.lit(" "), F.lit("  "))
    same = reduce(lambda c, v: F.replace(c, F.lit(f" {v[0].replace(' ', '  ')} "), F.lit(f" {v[1].replace(' ', '  ')} ")), SPELLINGS, spaced)
    return F.trim(F.replace(same, F.lit("  "), F.lit(" ")))


def digest(text: Column) -> Column:
    return F.sha2(F.encode(canonical(text), "UTF-8"), 256)


def known_digests(spark: SparkSession, known: list[tuple[str, str]] | None = None) -> DataFrame:
    """(license, digest) of the known texts, one row per digest; the list lies in the driver, so it may be broadcast."""
    rows = spark.createDataFrame(all_known() if known is None else known, "license string, text string")
    return F.broadcast(rows.select("license", digest(F.col("text")).alias("digest")).groupBy("digest").agg(F.min("license").alias("license")))


def scan(docs: DataFrame, known: DataFrame, id_column: str = "doc_id", text_column: str = "text") -> DataFrame:
    """One row per row of ``docs``: doc_id, digest of the whole canonical text, license (null: none).

    Null and empty texts, and those with nothing but notices or punctuation, have the digest of the
    empty form and no licence.  Repeated rows stay; an empty table gives no rows; other columns of
    ``docs`` are ignored.  The known side holds one row per digest and is joined by hash.
    """
    ours = docs.select(F.col(id_column).alias("doc_id"), digest(F.col(text_column)).alias("digest"))
    return ours.join(known.select("digest", "license"), "digest", "left").select("doc_id", "digest", "license")
