"""License scan: known sentences, then ordered rules over their sequence.

A text is normalised (lower case, runs of anything but letters and digits become one
space, version numbers keep their dot). Sentences end after . ! ? and at lines without a
letter or digit, as between paragraphs; within a sentence, single line ends with whatever
comment signs stand there (#, *, //) count as spaces. A known licence sentence is found
where it stands from a sentence's or line's start to a sentence's or line's end, so a
wrapped sentence is found, and so is a notice on a line of its own; of several that start
at one place the longest is taken. The identifiers found, in text order, are matched against the rules in turn; a rule consumes what it matches, so that a
later, more general rule does not see it. All of it is DataFrame functions.
"""

from __future__ import annotations

import re

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from shelfwise.llm.common import pick

# Known sentences: public licence texts and usual notices. Fixed values.
SENTENCES = {
    "apache-notice": "Licensed under the Apache License, Version 2.0.",
    "apache-header": 'Licensed under the Apache License, Version 2.0 (the "License"); you may not use this file except in compliance with the License.',
    "apache-copy": "You may obtain a copy of the License at",
    "as-is-basis": 'Unless required by applicable law or agreed to in writing, software distributed under the License is distributed on an "AS IS" BASIS, WITHOUT WARRANTIES OR CONDITIONS OF ANY KIND, either express or implied.',
    "apache-limits": "See the License for the specific language governing permissions and limitations under the License.",
    "mit-notice": "Released under the MIT License.",
    "mit-licensed": "Licensed under the MIT License.",
    "mit-grant": 'Permission is hereby granted, free of charge, to any person obtaining a copy of this software and associated documentation files (the "Software"), to deal in the Software without restriction, including without limitation the rights to use, copy, modify, merge, publish, distribute, sublicense, and/or sell copies of the Software, and to permit persons to whom the Software is furnished to do so, subject to the following conditions:',
    "mit-keep": "The above copyright notice and this permission notice shall be included in all copies or substantial portions of the Software.",
    "gpl3-notice": "This work is licensed under the GNU General Public License, version 3.",
    "gpl-free": "This program is free software: you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation, either version 3 of the License, or (at your option) any later version.",
    "gpl2-free": "This program is free software; you can redistribute it and/or modify it under the terms of the GNU General Public License as published by the Free Software Foundation; either version 2 of the License, or (at your option) any later version.",
    "gpl-hope": "This program is distributed in the hope that it will be useful, but WITHOUT ANY WARRANTY; without even the implied warranty of MERCHANTABILITY or FITNESS FOR A PARTICULAR PURPOSE.",
    "cc-by-nc-notice": "Licensed under CC BY-NC 4.0.",
    "cc-by-notice": "Licensed under CC BY 4.0.",
    "cc-by-sa-notice": "Licensed under CC BY-SA 4.0.",
    "bsd-grant": "Redistribution and use in source and binary forms, with or without modification, are permitted provided that the following conditions are met:",
    "rights-reserved": "All rights reserved.",
}

# Rules in order: (licence, identifiers that follow one another). Fixed values.
RULES = [
    ("Apache-2.0", ["apache-header", "apache-copy", "as-is-basis", "apache-limits"]),
    ("Apache-2.0", ["apache-header", "as-is-basis", "apache-limits"]),
    ("MIT", ["mit-grant", "mit-keep"]),
    ("GPL-3.0-or-later", ["gpl-free", "gpl-hope"]),
    ("GPL-2.0-or-later", ["gpl2-free", "gpl-hope"]),
    ("BSD", ["rights-reserved", "bsd-grant"]),
    ("Apache-2.0", ["apache-header"]),
    ("Apache-2.0", ["apache-notice"]),
    ("MIT", ["mit-notice"]),
    ("MIT", ["mit-licensed"]),
    ("MIT", ["mit-grant"]),
    ("GPL-3.0-only", ["gpl3-notice"]),
    ("GPL-3.0-or-later", ["gpl-free"]),
    ("GPL-2.0-or-later", ["gpl2-free"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-notice"]),
    ("CC-BY-4.0", ["cc-by-notice"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-notice"]),
    ("BSD", ["bsd-grant"]),
    ("Proprietary", ["rights-reserved"]),
]

# Every known sentence has one of these, in any case; texts with none have no known sentence.
# Single words, which stand alike in a text and in what it is normalised to.
MARKS = r"(?i)licen[cs]e|copyright|warranty|redistribution|rights"


def lined(text: Column) -> Column:
    """A text, normalised: sentence ends become ``x02`` and line ends within a sentence stay."""
    out = F.translate(F.lower(text), "\x02", " ")
    for pattern, by in ((r"[.!?]\s+", "\x02"), (r"[^a-z0-9.\n\x02]+|\.(?![0-9])|(?<![0-9])\.", " "), (" +", " "),
                        (r" ?\n ?(?:\n ?)+", "\x02"), (r" ?\n ?", "\n"), (r"[ \n]?\x02[ \n\x02]*", "\x02")):
        out = F.regexp_replace(out, pattern, by)
    return out


def plain(sentence: str) -> str:
    """The table's own sentences, normalised."""
    return re.sub(r" +", " ", re.sub(r"[^a-z0-9.]+|\.(?![0-9])|(?<![0-9])\.", " ", sentence.lower())).strip()


def scan(docs: DataFrame, sentences: dict[str, str] | None = None, rules: list[tuple[str, list[str]]] | None = None,
         marks: str = MARKS) -> DataFrame:
    """One row for each row of ``docs``: doc_id, sentence_ids, licenses, n_unmatched.

    ``sentence_ids`` has the known sentences in text order and ``licenses`` the licences
    whose rules fit, sorted, each once, both joined by commas and empty where there are
    none; ``n_unmatched`` counts the identifiers that no rule consumed. Null and empty
    texts have none. Null and repeated doc_ids are scanned each, an empty table gives no
    rows, other columns are not read. Each of ``sentences`` must have one of ``marks``.
    """
    sentences = SENTENCES if sentences is None else sentences
    rules = RULES if rules is None else rules
    if unmarked := [name for name, s in sentences.items() if not re.search(marks, plain(s))]:
        raise ValueError(f"sentences without a mark would never be found: {', '.join(unmarked)}")
    known = F.create_map(*(F.lit(x) for name, s in sentences.items() for x in (plain(s), name)))
    text = F.coalesce("text", F.lit(""))
    ways = sorted({plain(s) for s in sentences.values()}, key=len, reverse=True)
    pattern = "(?<=[\n\x02])(?:" + "|".join(w.replace(".", r"\.").replace(" ", r"[ \n]") for w in ways) + ")(?=[\n\x02])"
    whole = lined(F.concat(F.lit("\n\n"), text, F.lit("\n\n")))
    ids = F.transform(F.regexp_extract_all(whole, F.lit(pattern), F.lit(0)), lambda x: F.element_at(known, F.translate(x, "\n", " ")))
    found = pick(docs, "doc_id", "text").select(
        F.col("doc_id").cast("long"),
        F.when(text.rlike(marks), F.array_join(ids, ",")).otherwise("").alias("sentence_ids"))
    out = found.withColumn("left", F.concat(F.lit(","), F.regexp_replace("sentence_ids", ",", ",,"), F.lit(",")))
    names = []
    for i, (name, ids_) in enumerate(rules):
        pattern = "".join(f",{x}," for x in ids_)
        hit = F.contains(F.col("left"), F.lit(pattern))
        out = out.select("doc_id", "sentence_ids", *(f"h{k}" for k in range(i)), F.when(hit, name).alias(f"h{i}"),
                         F.replace(F.col("left"), F.lit(pattern), F.lit("")).alias("left"))
        names.append(f"h{i}")
    rest = F.length(F.regexp_replace("left", "[^,]", ""))
    return out.select("doc_id", "sentence_ids",
                      F.array_join(F.array_sort(F.array_distinct(F.array_compact(F.array(*names)))), ",").alias("licenses"),
                      F.when(F.col("sentence_ids") == "", 0).otherwise(rest / 2).cast("long").alias("n_unmatched"))


def oracle() -> str:
    """The same as DuckDB SQL, without the marks: every sentence is looked up."""
    known = ", ".join(f"'{plain(s)}': '{n}'" for n, s in SENTENCES.items())
    # RE2 has no look-around: dots between digits are kept as a sign, the others go.
    norm = ("trim(regexp_replace(replace(replace(regexp_replace(lower(x), '([0-9])\\.([0-9])', '\\1\x01\\2', 'g'), '.', ' '), chr(1), '.'), "
            "'[^a-z0-9.]+', ' ', 'g'))").replace("\x01", "' || chr(1) || '")
    chain = "\n".join(
        f"r{i + 1} AS (SELECT *, CASE WHEN contains(l{i}, '{p}') THEN '{name}' END AS h{i}, replace(l{i}, '{p}', '') AS l{i + 1} FROM r{i}),"
        for i, (name, p) in enumerate((n, "".join(f",{x}," for x in ids)) for n, ids in RULES))
    hits = ", ".join(f"h{i}" for i in range(len(RULES)))
    return f"""
WITH cut AS (
  SELECT doc_id, list_filter(list_transform(
      string_split(regexp_replace(coalesce(text, ''), '([.!?])\\s+', '\\1' || chr(10), 'g'), chr(10)),
      lambda x: (MAP {{{known}}})[{norm}]), lambda x: x IS NOT NULL) AS ids
  FROM documents),
r0 AS (SELECT doc_id, coalesce(array_to_string(ids, ','), '') AS sentence_ids,
              ',' || replace(coalesce(array_to_string(ids, ','), ''), ',', ',,') || ',' AS l0 FROM cut),
{chain}
done AS (SELECT *, list_sort(list_distinct(list_filter([{hits}], lambda x: x IS NOT NULL))) AS found FROM r{len(RULES)})
SELECT doc_id, sentence_ids, coalesce(array_to_string(found, ','), '') AS licenses,
       CASE WHEN sentence_ids = '' THEN 0 ELSE (length(l{len(RULES)}) - length(replace(l{len(RULES)}, ',', ''))) // 2 END AS n_unmatched
FROM done
"""
