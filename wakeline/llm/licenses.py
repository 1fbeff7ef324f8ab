"""License scans by sentence rules: sentences become identifiers, their order decides the licence.

A text is cut into sentences in two ways: at full stops, with line ends as
blanks (for wrapped notices), and at full stops and line ends (for notices
between other lines). The reading with more known sentences counts, the first
if they have equally many. The identifiers in text order are matched against
licence rules from the longest to the shortest; each rule takes the runs of
identifiers that no longer rule has taken.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F

# Sentences of public licences and notices as normalised here, with their identifiers.
SENTENCES = {
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated "
    "documentation files the software to deal in the software without restriction including without limitation the "
    "rights to use copy modify merge publish distribute sublicense and/or sell copies of the software and to permit "
    "persons to whom the software is furnished to do so subject to the following conditions": "mit-grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of "
    "the software": "mit-notice",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the "
    "warranties of merchantability fitness for a particular purpose and noninfringement": "mit-as-is",
    "in no event shall the authors or copyright holders be liable for any claim damages or other liability whether in an "
    "action of contract tort or otherwise arising from out of or in connection with the software or the use or other "
    "dealings in the software": "mit-liability",
    "released under the mit license": "mit-short",
    "licensed under the mit license": "mit-short",
    "this software is released under the mit license": "mit-short",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the "
    "following conditions are met": "bsd-grant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following "
    "disclaimer": "bsd-source",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following "
    "disclaimer in the documentation and/or other materials provided with the distribution": "bsd-binary",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote "
    "products derived from this software without specific prior written permission": "bsd-names",
    "licensed under the bsd license": "bsd-short",
    "permission to use copy modify and/or distribute this software for any purpose with or without fee is hereby granted "
    "provided that the above copyright notice and this permission notice appear in all copies": "isc-grant",
    "the software is provided as is and the author disclaims all warranties with regard to this software including all "
    "implied warranties of merchantability and fitness": "isc-as-is",
    "licensed under the apache license version 2.0": "apache-short",
    "licensed under the apache license version 2.0 the license you may not use this file except in compliance with the "
    "license": "apache-use",
    "you may obtain a copy of the license at": "apache-copy",
    "http www.apache.org/licenses/license-2.0": "apache-address",
    "unless required by applicable law or agreed to in writing software distributed under the license is distributed on "
    "an as is basis without warranties or conditions of any kind either express or implied": "apache-as-is",
    "see the license for the specific language governing permissions and limitations under the license": "apache-see",
    "this program is distributed in the hope that it will be useful but without any warranty without even the implied "
    "warranty of merchantability or fitness for a particular purpose": "gpl-hope",
    "see the gnu general public license for more details": "gpl-see",
    "this source code form is subject to the terms of the mozilla public license v 2.0": "mpl-terms",
    "this is free and unencumbered software released into the public domain": "unlicense-head",
    "this work is released into the public domain": "public-domain",
    "all rights reserved": "all-rights",
}
# Sentences that differ in a version only, by rule: text, identifier, versions.
VERSIONED = (
    ("this work is licensed under the gnu general public license version {}", "gpl-short-{}", ("1", "2", "3")),
    ("licensed under the gnu general public license version {}", "gpl-short-{}", ("1", "2", "3")),
    ("this program is free software you can redistribute it and/or modify it under the terms of the gnu general public "
     "license as published by the free software foundation either version {} of the license or at your option any later "
     "version", "gpl-free-{}", ("2", "3")),
    ("licensed under the gnu lesser general public license version {}", "lgpl-short-{}", ("2.1", "3")),
    *((f"licensed under cc {kind} {{}}", f"cc-{kind}-{{}}", ("2.0", "3.0", "4.0"))
      for kind in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd")),
)
# Ordered rules: the identifiers in sequence, and the licence they make.
RULES = (
    (("mit-grant", "mit-notice", "mit-as-is", "mit-liability"), "MIT"),
    (("apache-use", "apache-copy", "apache-address", "apache-as-is", "apache-see"), "Apache-2.0"),
    (("bsd-grant", "bsd-source", "bsd-binary", "bsd-names"), "BSD-3-Clause"),
    (("bsd-grant", "bsd-source", "bsd-binary"), "BSD-2-Clause"),
    (("gpl-free-2", "gpl-hope", "gpl-see"), "GPL-2.0-or-later"),
    (("gpl-free-3", "gpl-hope", "gpl-see"), "GPL-3.0-or-later"),
    (("isc-grant", "isc-as-is"), "ISC"),
    (("mit-short",), "MIT"),
    (("bsd-short",), "BSD"),
    (("apache-short",), "Apache-2.0"),
    *(((f"gpl-short-{v}",), f"GPL-{v}.0-only") for v in ("1", "2", "3")),
    *(((f"gpl-free-{v}",), f"GPL-{v}.0-or-later") for v in ("2", "3")),
    (("lgpl-short-2.1",), "LGPL-2.1-only"),
    (("lgpl-short-3",), "LGPL-3.0-only"),
    *(((f"cc-{kind}-{v}",), f"CC-{kind.upper()}-{v}")
      for kind in ("by", "by-sa", "by-nc", "by-nd", "by-nc-sa", "by-nc-nd") for v in ("2.0", "3.0", "4.0")),
    (("mpl-terms",), "MPL-2.0"),
    (("unlicense-head",), "Unlicense"),
    (("public-domain",), "public domain"),
    (("all-rights",), "proprietary"),
)
# A text without any of these stems has no known sentence. Each lies in one word, which no line end parts.
STEMS = ("apache.org", "licen", "permi", "right", "redistribution", "warrant", "domain", "liable")
# The SQL form still looks for these, and skips sentences of 2,000 characters or more.
SQL_STEMS = ("apache.org", "licen", "permi", "right", "redistribution", "warrant", "public domain", "liable")
# Ends of sentences: an end mark before a blank or the end, or an empty line; and any line end.
ENDS = r"[.!?]\s*\n|[.!?][ \t]+|[.!?]\z|\n[ \t]*\n"
ENDS_AND_LINES = r"[.!?][ \t]+|[.!?]\z|[.!?]?\n"


def sentences() -> dict[str, str]:
    """All known sentences and their identifiers."""
    versions = {text.format(v): name.format(v) for text, name, vs in VERSIONED for v in vs}
    return SENTENCES | versions


# What becomes a blank, in turn: all but letters, digits and . / + -, and of these what is not inside a word.
NOISE = (r"[^a-z0-9./+ -]+", r"(^| )[./+-]+", r"[./+-]+( |\z)", r" +")


def normal(sentence: Column) -> Column:
    """Lower case, words with single blanks between them; punctuation stays inside words only."""
    plain = F.lower(sentence)
    for noise in NOISE:
        plain = F.regexp_replace(plain, noise, " ")
    return F.trim(plain)


def _identified(text: Column, ends: str) -> Column:
    """The identifiers of the known sentences of a text, as '<id><id>'."""
    known = F.create_map(*[F.lit(x) for pair in sorted(sentences().items()) for x in pair])
    names = F.transform(F.split(text, ends, -1), lambda s: F.element_at(known, normal(s)))
    return F.array_join(F.transform(F.filter(names, lambda n: n.isNotNull()), lambda n: F.concat(F.lit("<"), n, F.lit(">"))), "")


def _count(ids: Column) -> Column:
    return F.length(ids) - F.length(F.replace(ids, F.lit("<"), F.lit("")))


def _matched(ids: Column) -> Column:
    """What the ordered rules make of an identifier sequence: struct(rest, found), found as ';a;b;'."""
    rules = F.array(*[F.struct(F.lit("".join(f"<{n}>" for n in names)).alias("ids"), F.lit(licence + ";").alias("licence"))
                      for names, licence in RULES])
    start = F.struct(ids.alias("rest"), F.lit(";").alias("found"))

    def apply(state, rule):
        found = F.when(F.contains(state["found"], F.concat(F.lit(";"), rule["licence"])), state["found"]).otherwise(
            F.concat(state["found"], rule["licence"]))
        return F.when(F.contains(state["rest"], rule["ids"]), F.struct(
            F.replace(state["rest"], rule["ids"], F.lit("|")).alias("rest"), found.alias("found"))).otherwise(state)
    return F.aggregate(rules, start, apply)


def scan(docs: DataFrame, text: str = "text") -> DataFrame:
    """Adds `_licence`: the known sentences in order, the licences found, and how many sentences no rule took.

    Licences stand in the order of the rules, each once. A text that is null,
    empty or without a known sentence has empty strings and zeros. All columns
    are kept.
    """
    body = F.coalesce(F.col(text), F.lit(""))
    small = F.lower(body)
    likely = F.contains(small, F.lit(STEMS[0]))
    for stem in STEMS[1:]:
        likely = likely | F.contains(small, F.lit(stem))

    def best(found):
        a, b = found["wrapped"], found["lines"]
        return F.when(_count(b) > _count(a), b).otherwise(a)

    def read():
        wrapped = _identified(F.regexp_replace(F.regexp_replace(body, ENDS, "\x01"), "\n", " "), "\x01")
        return F.struct(wrapped.alias("wrapped"), _identified(body, ENDS_AND_LINES).alias("lines"))

    ids = F.when(likely, F.transform(F.array(read()), best).getItem(0)).otherwise("")

    def judged(seq):
        return F.transform(F.array(_matched(seq)), lambda m: F.struct(
            seq.alias("sentence_ids"), _count(seq).cast("bigint").alias("n_sentences"),
            F.trim(m["found"], F.lit(";")).alias("licences"),
            _count(m["rest"]).cast("bigint").alias("n_unmatched"))).getItem(0)
    return docs.withColumn("_licence", F.transform(F.array(ids), judged).getItem(0))


def oracle() -> str:
    """The scan of `documents` in DuckDB SQL."""
    def lit(value):
        return "'" + value.replace("'", "''") + "'"

    pairs = sorted(sentences().items())
    known = f"map([{', '.join(lit(k) for k, _ in pairs)}], [{', '.join(lit(v) for _, v in pairs)}])"
    normalised = "lower(s)"
    for noise in NOISE:
        normalised = f"regexp_replace({normalised}, {lit(noise)}, ' ', 'g')"

    def identified(split):
        return (f"array_to_string(list_transform(list_filter(list_transform({split}, lambda s: case when length(s) < 2000 "
                f"then m[trim({normalised})] end), lambda n: n is not null), lambda n: '<' || n || '>'), '')")
    steps = ["matched0 as (select doc_id, ids, ids as rest, ';' as found from picked)"]
    for i, (names, licence) in enumerate(RULES):
        rule, own = lit("".join(f"<{n}>" for n in names)), lit(licence + ";")
        steps.append(f"matched{i + 1} as (select doc_id, ids, replace(rest, {rule}, '|') as rest, case when contains(rest, {rule}) "
                     f"and not contains(found, ';' || {own}) then found || {own} else found end as found from matched{i})")
    count = "length({0}) - length(replace({0}, '<', ''))"
    wrapped = f"string_split(regexp_replace(regexp_replace(body, {lit(ENDS)}, chr(1), 'g'), '\\n', ' ', 'g'), chr(1))"
    lines = f"string_split_regex(body, {lit(ENDS_AND_LINES)})"
    likely = " or ".join(f"contains(lower(body), {lit(s)})" for s in SQL_STEMS)
    return f"""with known as (select {known} as m),
texts as (select doc_id, coalesce(text, '') as body, m from documents, known),
readings as (select doc_id, case when {likely} then {identified(wrapped)} else '' end as wrapped,
  case when {likely} then {identified(lines)} else '' end as lines from texts),
picked as (select doc_id, case when {count.format('lines')} > {count.format('wrapped')} then lines else wrapped end as ids
  from readings),
{', '.join(steps)}
select doc_id, ids as sentence_ids, {count.format('ids')} as n_sentences, trim(found, ';') as licences,
  {count.format('rest')} as n_unmatched from matched{len(RULES)}"""
