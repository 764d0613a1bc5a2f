"""License scans by canonical digest (operator 6). DataFrame functions only.

A text is brought to a canonical form: A-Z lowered, every run of ASCII characters
other than letters and digits made one space, and equivalent spellings made one. It
is a stream of words: where its lines break makes no difference. Copyright statements
(lines that start with a mark followed by a year, a holder or a blank to fill in,
lines of marks after them, and a first line of a block that starts with "copyright")
are taken out. A licence may itself hold such a statement, and a statement ends with
its line, so every text also has the form with nothing taken out, and both are looked
up. Thus a licence is found however its lines are wrapped. The digest of the whole
canonical text is joined with the digests of known licences. The units looked up are
the whole document and, for notices inside other text, each of its lines and its
blocks (what lines without letters and digits separate): a known text is found where
all its blocks follow one another, or where it is one block. Blocks of a document that
is known as a whole are not listed. Of MIT, ISC, BSD, Apache-2.0, GPL, MPL-2.0 and CC0
the entire texts are known, with and without title, from `license_texts`; of the
other Creative Commons licences only notices.

Each text is read once. Only units whose canonical length some known text or block has
are hashed, and only their digests travel. The known texts are a table; Spark broadcasts
its digests while they are small.

Defined results
- NULL or blank text, or one of copyright statements only: the empty canonical text,
  which is never looked up.
- NULL id: a row like any other. Repeated rows: each is returned, with the same
  result. Known texts with equal canonical forms: the smallest licence id.
- Very long texts: read whole, in one row's memory.
- U+0001 separates blocks like an empty line.
- Empty tables: no rows, or no matches. Extra columns: ignored.
"""

from __future__ import annotations

from pathlib import Path

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from arrears.llm.common import ascii_lower, let, materialise

# Copyright statements, what separates words and blocks, and equivalent spellings.
MARKS = ("copyright", "(c)", "©", "all rights reserved")
MORE_MARKS = r"(?:\n[ \t]*(?:copyright|\(c\)|©|all rights reserved)[^\n]*)*"
HOLDER_LINE = r"(^|\n[ \t]*\n)[ \t]*copyright[^\n]*" + MORE_MARKS
STATEMENT = (r"(^|\n)[ \t]*(?:copyright[ \t]*(?:\(c\)|©|[0-9]{4}|by[ \t]|[<\[{])|\(c\)[ \t]*(?:[0-9]{4}|copyright)|©|all rights reserved)"
             r"[^\n]*") + MORE_MARKS
BETWEEN_BLOCKS = r"\n[\x00-\x2F\x3A-\x60\x7B-\x7F]*\n"
IN_TEXT = r"[\x00\x02-\x2F\x3A-\x60\x7B-\x7F]+"       # all but letters, digits and the separator of blocks
IN_LINE = r"[\x00-\x09\x0B-\x2F\x3A-\x60\x7B-\x7F]+"  # all but letters, digits and the end of a line
SPELLINGS = (
    ("acknowledgement", "acknowledgment"), ("analogue", "analog"), ("authorisation", "authorization"),
    ("authorised", "authorized"), ("cancelled", "canceled"), ("favour", "favor"), ("fulfil ", "fulfill "),
    ("licence", "license"), ("merchantibility", "merchantability"), ("non commercial", "noncommercial"),
    ("non infringement", "noninfringement"), ("organisation", "organization"), ("sub license", "sublicense"),
    ("sub licence", "sublicense"), ("whilst", "while"), ("wilful", "willful"),
)

# Known licence texts and notices, by licence id: public standard wordings.
KNOWN = (
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0."),
    ("Apache-2.0", "Licensed under the Apache License, Version 2.0 (the \"License\");"),
    ("Apache-2.0", "SPDX-License-Identifier: Apache-2.0"),
    ("BSD-2-Clause", "SPDX-License-Identifier: BSD-2-Clause"),
    ("BSD-3-Clause", "SPDX-License-Identifier: BSD-3-Clause"),
    ("CC-BY-4.0", "Licensed under CC BY 4.0."),
    ("CC-BY-NC-4.0", "Licensed under CC BY-NC 4.0."),
    ("CC-BY-NC-4.0", "Licensed under a Creative Commons Attribution-NonCommercial 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under CC BY-SA 4.0."),
    ("CC-BY-4.0", "Licensed under a Creative Commons Attribution 4.0 International License."),
    ("CC-BY-SA-4.0", "Licensed under a Creative Commons Attribution-ShareAlike 4.0 International License."),
    ("CC0-1.0", "SPDX-License-Identifier: CC0-1.0"),
    ("GPL-2.0", "SPDX-License-Identifier: GPL-2.0"),
    ("GPL-2.0", "This work is licensed under the GNU General Public License, version 2."),
    ("GPL-3.0", "SPDX-License-Identifier: GPL-3.0"),
    ("GPL-3.0", "This work is licensed under the GNU General Public License, version 3."),
    ("ISC", "Permission to use, copy, modify, and/or distribute this software for any purpose with or without fee "
            "is hereby granted, provided that the above copyright notice and this permission notice appear in all "
            "copies.\nTHE SOFTWARE IS PROVIDED \"AS IS\" AND THE AUTHOR DISCLAIMS ALL WARRANTIES WITH REGARD TO "
            "THIS SOFTWARE INCLUDING ALL IMPLIED WARRANTIES OF MERCHANTABILITY AND FITNESS. IN NO EVENT SHALL THE "
            "AUTHOR BE LIABLE FOR ANY SPECIAL, DIRECT, INDIRECT, OR CONSEQUENTIAL DAMAGES OR ANY DAMAGES "
            "WHATSOEVER RESULTING FROM LOSS OF USE, DATA OR PROFITS, WHETHER IN AN ACTION OF CONTRACT, NEGLIGENCE "
            "OR OTHER TORTIOUS ACTION, ARISING OUT OF OR IN CONNECTION WITH THE USE OR PERFORMANCE OF THIS "
            "SOFTWARE."),
    ("MIT", "Permission is hereby granted, free of charge, to any person obtaining a copy of this software and "
            "associated documentation files (the \"Software\"), to deal in the Software without restriction, "
            "including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, "
            "and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, "
            "subject to the following conditions:\nThe above copyright notice and this permission notice shall be "
            "included in all copies or substantial portions of the Software.\nTHE SOFTWARE IS PROVIDED \"AS IS\", "
            "WITHOUT WARRANTY OF ANY KIND, EXPRESS OR IMPLIED, INCLUDING BUT NOT LIMITED TO THE WARRANTIES OF "
            "MERCHANTABILITY, FITNESS FOR A PARTICULAR PURPOSE AND NONINFRINGEMENT. IN NO EVENT SHALL THE AUTHORS "
            "OR COPYRIGHT HOLDERS BE LIABLE FOR ANY CLAIM, DAMAGES OR OTHER LIABILITY, WHETHER IN AN ACTION OF "
            "CONTRACT, TORT OR OTHERWISE, ARISING FROM, OUT OF OR IN CONNECTION WITH THE SOFTWARE OR THE USE OR "
            "OTHER DEALINGS IN THE SOFTWARE."),
    ("MIT", "Licensed under the MIT License."),
    ("MIT", "Released under the MIT License."),
    ("MIT", "SPDX-License-Identifier: MIT"),
    ("MPL-2.0", "SPDX-License-Identifier: MPL-2.0"),
)


# Titles that the texts are published under. The other files of `license_texts` begin with theirs.
TITLES = {
    "BSD-2-Clause": ("BSD 2-Clause License", "The BSD 2-Clause License", "Simplified BSD License"),
    "BSD-3-Clause": ("BSD 3-Clause License", "The BSD 3-Clause License", "New BSD License"),
    "ISC": ("ISC License", "The ISC License", "ISC License (ISC)"),
    "MIT": ("MIT License", "The MIT License", "The MIT License (MIT)", "MIT License (MIT)"),
}
END = "END OF TERMS AND CONDITIONS"          # what follows tells how to apply the licence


def full_texts() -> list[tuple[str, str]]:
    """(license, text) of entire licences, as they are found: with or without title and appendix."""
    given = [(i, t.replace("\n", "\n\n")) for i, t in KNOWN if "\n" in t]
    given += [(p.stem, p.read_text()) for p in sorted((Path(__file__).parent / "license_texts").glob("*.txt"))]
    out = []
    for name, text in given:
        terms, end, _ = text.partition(END)
        texts = [text, terms + end, terms] if end else [text]
        if name in TITLES:
            texts += [f"{title}\n\n{text}" for title in TITLES[name]]
        else:                                # the first block is the title
            texts += [t.strip().split("\n\n", 1)[1] for t in texts]
        out += [(name, t) for t in texts]
    return out


def _low(text: Column) -> Column:
    return ascii_lower(F.coalesce(text, F.lit("")))


def _marked(low: Column) -> Column:
    return F.contains(low, F.lit(MARKS[0])) | F.contains(low, F.lit(MARKS[1])) | F.contains(
        low, F.lit(MARKS[2])) | F.contains(low, F.lit(MARKS[3]))


def _without_statements(low: Column) -> Column:
    return F.regexp_replace(F.regexp_replace(low, STATEMENT, "$1"), HOLDER_LINE, "$1")


def _respelled(text: Column, one: str, other: str) -> Column:
    # looking for a word is much cheaper than replacing it
    return let(text, lambda t: F.when(F.contains(t, F.lit(one)), F.replace(t, F.lit(one), F.lit(other))).otherwise(t))


def _spelled(text: Column) -> Column:
    for one, other in SPELLINGS:
        text = _respelled(text, one, other)
    return text


def _units(text: Column, between: str) -> Column:
    return F.transform(F.split(_spelled(F.concat(F.lit(" "), text, F.lit(" "))), between), lambda unit: F.trim(unit))


def _blocks(low: Column) -> Column:
    """The canonical blocks of a lowered text, none empty."""
    text = F.regexp_replace(F.regexp_replace(low, BETWEEN_BLOCKS, " \x01 "), IN_TEXT, " ")
    return F.filter(_units(text, "\x01"), lambda block: block != "")


def _lines(low: Column) -> Column:
    """The canonical lines of a lowered text; empty ones keep their places."""
    return _units(F.replace(F.regexp_replace(low, IN_LINE, " "), F.lit("\n"), F.lit(" \n ")), "\n")


def _joined(blocks: Column) -> Column:
    return F.array_join(blocks, " ")


def _sha(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def canonical(text: Column) -> Column:
    return _joined(_blocks(_without_statements(_low(text))))


def digest(text: Column) -> Column:
    return _sha(canonical(text))


NOTHING = "e3b0c44298fc1c149afbf4c8996fb92427ae41e4649b934ca495991b7852b855"   # SHA-256 of no bytes
LENGTHS = 1 << 16        # up to so many different lengths of known units, other units are not hashed


def known_licenses(spark: SparkSession) -> DataFrame:
    return spark.createDataFrame([*KNOWN, *full_texts()], "license string, text string")


def known_forms(known: DataFrame) -> DataFrame:
    """(license, blocks): the canonical blocks of each known text, with and without its statements, none empty."""
    low = _low(known["text"])
    forms = known.select("license", F.explode(F.array(_blocks(low), _blocks(_without_statements(low)))).alias("blocks"))
    return forms.filter(F.size("blocks") > 0).distinct()


def _of_length(units: Column, known: DataFrame) -> Column:
    """Those of an array of struct(at, unit) that are as long as some known unit: a superset of the known ones."""
    lengths = [r.n for r in known.select(F.length("unit").alias("n")).distinct().limit(LENGTHS + 1).collect()]
    if len(lengths) > LENGTHS:
        return F.filter(units, lambda u: u["unit"] != "")
    return F.filter(units, lambda u: F.length(u["unit"]).isin(lengths))


def _placed(units: Column) -> Column:
    return F.transform(units, lambda unit, i: F.struct(i.alias("at"), unit.alias("unit")))


def _hashed(units: Column) -> Column:
    return F.transform(units, lambda u: F.struct(u["at"].alias("at"), _sha(u["unit"]).alias("known")))


def scan(docs: DataFrame, known: DataFrame, *, id_col="doc_id", text_col="text") -> DataFrame:
    """One row per document: doc_id, text_digest, license (of the whole text), notices (of lines and blocks), n_notice_lines."""
    forms = materialise(known_forms(known).withColumn("of", _sha(_joined(F.col("blocks")))), "license-forms")
    texts = forms.select(_joined(F.col("blocks")).alias("unit"))
    names = materialise(forms.groupBy(F.col("of").alias("known")).agg(F.min("license").alias("license")), "license-known")
    # a text as one block is another arrangement than its blocks
    arranged = forms.select("license", "of", F.explode(F.array(F.col("blocks"), F.array(_joined(F.col("blocks"))))).alias("blocks")).distinct()
    parts = materialise(arranged.select(
        "license", "of", F.size("blocks").alias("n_blocks"), F.posexplode("blocks").alias("part", "unit")), "license-blocks")

    # read each text once: digests of the whole, and of the lines and blocks that may be known
    low = let(_low(docs[text_col]), lambda t: F.struct(
        _lines(t).alias("lines"), _blocks(t).alias("plain"),
        F.when(_marked(t), _blocks(_without_statements(t))).alias("stated")))
    read = docs.select(docs[id_col].alias("doc_id"), low.alias("u"))
    plain, stated = F.col("u.plain"), F.col("u.stated")
    read = materialise(read.select(
        F.monotonically_increasing_id().alias("row"), "doc_id",
        _sha(_joined(F.coalesce(stated, plain))).alias("text_digest"),
        F.when(stated.isNotNull(), _sha(_joined(plain))).alias("plain_digest"),
        _hashed(_of_length(_placed(F.col("u.lines")), texts)).alias("lines"),
        _hashed(_of_length(_placed(plain), parts)).alias("plain"),
        _hashed(_of_length(_placed(F.coalesce(stated, F.array().cast("array<string>"))), parts)).alias("stated")), "license-units")

    hits = read.select("row", F.explode("lines").alias("u")).select("row", "u.*").join(names, "known").select("row", "at", "license")
    blocks = read.select("row", F.explode(F.array(
        F.struct(F.lit(False).alias("stated"), F.col("plain").alias("units")),
        F.struct(F.lit(True).alias("stated"), F.col("stated").alias("units")))).alias("f"))
    blocks = blocks.select("row", "f.stated", F.explode("f.units").alias("u")).select("row", "stated", "u.*")
    placed = parts.select("license", "of", "n_blocks", "part", _sha(F.col("unit")).alias("known"))
    runs = (blocks.join(placed, "known")
            .groupBy("row", "stated", "license", "of", "n_blocks", (F.col("at") - F.col("part")).alias("start"))
            .agg(F.count(F.lit(1)).alias("n")).filter("n = n_blocks"))
    # line notices and, unless the whole text is known, blocks
    hits = hits.withColumn("block_license", F.lit(None).cast("string")).unionByName(
        runs.select("row", F.col("license").alias("block_license")).distinct(), allowMissingColumns=True)
    found = hits.groupBy("row").agg(
        F.collect_set("license").alias("by_line"), F.collect_set("block_license").alias("by_block"),
        F.count("at").alias("n_notice_lines"))
    other = names.select(F.col("known").alias("other"), F.col("license").alias("other_license"))
    by_any = F.when(F.col("whole").isNull(), F.array_union("by_line", "by_block")).otherwise(F.col("by_line"))
    return (read.select("row", "doc_id", "text_digest", "plain_digest")
            .join(names, F.col("text_digest") == F.col("known"), "left")
            .join(other, F.col("plain_digest") == F.col("other"), "left")
            .withColumn("whole", F.coalesce("license", "other_license"))
            .join(found, "row", "left")
            .select("doc_id", "text_digest", F.col("whole").alias("license"),
                    F.coalesce(F.array_join(F.sort_array(by_any), ","), F.lit("")).alias("notices"),
                    F.coalesce("n_notice_lines", F.lit(0)).cast("long").alias("n_notice_lines")))
