"""Licence scans by sentence rules, in DataFrame functions only.

Texts are cut into sentences, normalised ones are looked up among known licence sentences, and each document's sequence
of identifiers is matched against the ordered rules of the licences, the longest rule first: what a run has matched no
shorter rule sees, so that a three-clause licence is not told as the two-clause one that its text holds too. A text is read twice: with line feeds as ends of
sentences (notices on lines of their own) and with empty lines only (wrapped paragraphs). The known sentences are a fixed table and
are broadcast; only rows with a known sentence are shuffled.

Cases: null and empty texts have no sentences; a sentence counts as often as it occurs, but a licence is named once;
rows that repeat an id have the findings of all of them; rows with a null id have none.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

# What licences say, normalised (lower case, other than letters and digits one space).
SENTENCES = [
    (1, "released under the mit license"),
    (2, "licensed under the mit license"),
    (3, "this project is licensed under the mit license"),
    (4, "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions"),
    (28, "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software"),
    (5, "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement"),
    (6, "licensed under the apache license version 2 0"),
    (7, "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license"),
    (8, "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis without warranties or conditions of any kind either express or implied"),
    (9, "see the license for the specific language governing permissions and limitations under the license"),
    (10, "this work is licensed under the gnu general public license version 3"),
    (11, "licensed under the gnu general public license version 3"),
    (12, "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    (13, "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version"),
    (14, "this program is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    (15, "licensed under cc by nc 4 0"),
    (16, "licensed under cc by 4 0"),
    (17, "licensed under cc by sa 4 0"),
    (18, "this work is licensed under a creative commons attribution 4 0 international license"),
    (19, "this work is licensed under a creative commons attribution noncommercial 4 0 international license"),
    (20, "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"),
    (21, "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"),
    (22, "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution"),
    (23, "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission"),
    (24, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies"),
    (25, "this source code form is subject to the terms of the mozilla public license v"),
    (26, "this is free and unencumbered software released into the public domain"),
    (27, "all rights reserved"),
    (29, "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version"),
    (30, "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    (31, "this library is distributed in the hope that it will be useful but without any warranty without even the implied warranty of merchantability or fitness for a particular purpose"),
    (32, "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version"),
    (33, "this software is provided as is without any express or implied warranty"),
    (34, "in no event will the authors be held liable for any damages arising from the use of this software"),
    (35, "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to the following restrictions"),
    (36, "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software and to prepare derivative works of the software and to permit third parties to whom the software is furnished to do so all subject to the following"),
    (37, "to the extent possible under law the author s have dedicated all copyright and related and neighboring rights to this software to the public domain worldwide"),
    (38, "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0 which is available at https www eclipse org legal epl 2 0"),
    (39, "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted"),
    (40, "this font software is licensed under the sil open font license version 1 1"),
    (41, "licensed under cc0 1 0"),
    (42, "licensed under cc by nc sa 4 0"),
    (43, "licensed under cc by nd 4 0"),
    (44, "this work is licensed under a creative commons attribution sharealike 4 0 international license"),
    (45, "if a copy of the mpl was not distributed with this file you can obtain one at http mozilla org mpl 2 0"),
    (46, "this source code form is subject to the terms of the mozilla public license v 2 0"),
]
# What the short notices call the licences.
CALLED = [
    ("MIT", "mit license"), ("Apache-2.0", "apache license version 2 0"), ("Apache-2.0", "apache license 2 0"), ("GPL-3.0", "gnu general public license version 3"), ("GPL-3.0", "gnu general public license v3 0"),
    ("GPL-2.0", "gnu general public license version 2"), ("LGPL-2.1", "gnu lesser general public license version 2 1"), ("LGPL-3.0", "gnu lesser general public license version 3"), ("AGPL-3.0", "gnu affero general public license version 3"),
    ("BSD-3-Clause", "bsd 3 clause license"), ("BSD-2-Clause", "bsd 2 clause license"), ("ISC", "isc license"), ("MPL-2.0", "mozilla public license version 2 0"), ("MPL-2.0", "mozilla public license 2 0"), ("Unlicense", "unlicense"),
    ("Zlib", "zlib license"), ("BSL-1.0", "boost software license version 1 0"), ("EPL-2.0", "eclipse public license version 2 0"), ("EPL-2.0", "eclipse public license 2 0"), ("Artistic-2.0", "artistic license 2 0"), ("OFL-1.1", "sil open font license version 1 1"),
]
SAID_AS = ["licensed under the", "released under the", "distributed under the", "this project is licensed under the", "this work is licensed under the", "this software is licensed under the", "available under the"]
# A licence is found where one of its rules, an ordered run of identifiers, stands in the sequence.
RULES = [
    ("MIT", ["1", "2", "3", "4,28,5", "4,28"]),
    ("Apache-2.0", ["6", "7", "7,8,9", "8,9"]),
    ("GPL-3.0", ["10", "11", "12,14"]),
    ("GPL-2.0", ["13,14"]),
    ("CC-BY-NC-4.0", ["15", "19"]),
    ("CC-BY-4.0", ["16", "18"]),
    ("CC-BY-SA-4.0", ["17", "44"]),
    ("BSD-3-Clause", ["20,21,22,23", "21,22,23"]),
    ("BSD-2-Clause", ["20,21,22"]),
    ("ISC", ["24"]),
    ("MPL-2.0", ["25", "46", "45"]),
    ("Unlicense", ["26"]),
    ("All-Rights-Reserved", ["27"]),
    ("LGPL-2.1", ["29,31"]),
    ("LGPL-3.0", ["30,31"]),
    ("AGPL-3.0", ["32,14"]),
    ("Zlib", ["33,34,35"]),
    ("BSL-1.0", ["36"]),
    ("CC0-1.0", ["37", "41"]),
    ("EPL-2.0", ["38"]),
    ("0BSD", ["39"]),
    ("OFL-1.1", ["40"]),
    ("Artistic-2.0", []),
    ("CC-BY-NC-SA-4.0", ["42"]),
    ("CC-BY-ND-4.0", ["43"]),
]


def _noticed() -> None:
    """Short notices, each way of saying with each name, numbered from 101 on; what the tables have already stays."""
    have, rules, number = {s for _, s in SENTENCES}, dict(RULES), 101
    for name, called in CALLED:
        for way in SAID_AS:
            if (said := f"{way} {called}") not in have:
                SENTENCES.append((number, said))
                rules[name].append(str(number))
            number += 1


_noticed()
NAMES = [name for name, _ in RULES]
#: Runs of several identifiers, the longest first; of equally long ones the first in the table.
RUNS = sorted(((name, rule) for name, rules in RULES for rule in rules if "," in rule), key=lambda x: -x[1].count(","))
ALONE = [(name, [r for r in rules if "," not in r]) for name, rules in RULES]


def _anchors() -> list[str]:
    """A few words of which every known sentence has one: a text with none of them is not cut into sentences at all."""
    left, out = [s for _, s in SENTENCES], []
    while left:
        words = sorted({w for s in left for w in s.split() if len(w) > 6})
        out.append(max(words, key=lambda w: sum(w in s for s in left)))
        left = [s for s in left if out[-1] not in s]
    return out


ANCHORS = _anchors()
ENDS, LINES, PARAGRAPHS = "[.!?]+[ \\t\\r\\n]+", "[\\r\\n]+", "\\n[ \\t\\r]*\\n"


def known(spark: SparkSession) -> DataFrame:
    rows = ", ".join(f"({i}, '{s}')" for i, s in SENTENCES)
    return spark.sql(f"SELECT CAST(id AS INT) AS id, said FROM VALUES {rows} AS t(id, said)")


def normal(sentence: Column) -> Column:
    return F.trim(F.regexp_replace(F.lower(sentence), "[^a-z0-9]+", " "))


def _held(rule: str) -> str:
    return "".join(f"<{x}>" for x in rule.split(","))


def _found(sequence: Column) -> Column:
    """Which licences (true or false, in the order of ``NAMES``) have a rule in the sequence. The longest rule wins: its
    run is taken out before shorter ones are tried."""
    left = F.array_join(F.transform(F.split(sequence, ","), lambda x: F.concat(F.lit("<"), x, F.lit(">"))), "")
    runs = F.array(*(F.struct(F.lit(NAMES.index(name)).alias("name"), F.lit(_held(rule)).alias("run")) for name, rule in RUNS))
    begin = F.struct(left.alias("left"), F.array().cast("array<int>").alias("names"))
    tried = F.aggregate(
        runs, begin,
        lambda acc, x: F.struct(F.replace(acc["left"], x["run"], F.lit("#")).alias("left"), F.when(F.contains(acc["left"], x["run"]), F.concat(acc["names"], F.array(x["name"]))).otherwise(acc["names"]).alias("names")),
        lambda acc: F.concat(F.transform(acc["names"], lambda n: F.concat(F.lit("n"), n.cast("string"))), F.regexp_extract_all(acc["left"], F.lit("<([0-9]+)>"), F.lit(1))),
    )
    return F.transform(F.array(*(F.array(F.lit(f"n{i}"), *map(F.lit, rules)) for i, (_, rules) in enumerate(ALONE))), lambda any_of: F.arrays_overlap(tried, any_of))


def scan(docs: DataFrame) -> DataFrame:
    """``doc_id, n_sentences, sentence_ids, licences`` for each row of ``docs``: how many known sentences, their
    identifiers in order, and the licences found, comma-joined in the order of the rules ('' if none)."""
    text = F.coalesce(F.col("text").cast("string"), F.lit(""))
    lowered = F.lower(text)
    some = docs.where("doc_id is not null").where(reduce(lambda a, b: a | b, (F.contains(lowered, F.lit(w)) for w in ANCHORS)))
    whole = F.split(text, f"{ENDS}|{PARAGRAPHS}", -1)
    lines = F.split(text, f"{ENDS}|{LINES}", -1)
    pieces = some.select("doc_id", F.posexplode(F.array(lines, whole)).alias("way", "cut")).select("doc_id", "way", F.posexplode("cut").alias("at", "said"))
    shortest = min(len(s) for _, s in SENTENCES)
    pieces = pieces.where(F.length("said") >= shortest).select("doc_id", "way", "at", normal(F.col("said")).alias("said"))
    ids = pieces.join(F.broadcast(known(docs.sparkSession)), "said").groupBy("doc_id", "way").agg(F.array_sort(F.collect_list(F.struct("at", "id"))).alias("seq"))
    ids = ids.select("doc_id", "way", F.transform("seq", lambda x: x["id"].cast("string")).alias("seq")).withColumn("joined", F.array_join("seq", ","))
    each = ids.groupBy("doc_id").agg(
        F.max(F.when(F.col("way") == 0, F.size("seq"))).alias("n"), F.max(F.when(F.col("way") == 0, F.col("joined"))).alias("line_ids"), F.max(F.when(F.col("way") == 1, F.col("joined"))).alias("text_ids")
    )
    either = F.zip_with(_found(F.coalesce("line_ids", F.lit(""))), _found(F.coalesce("text_ids", F.lit(""))), lambda a, b: a | b)
    both = F.filter(F.zip_with(either, F.array(*map(F.lit, NAMES)), lambda a, name: F.when(a, name)), lambda x: x.isNotNull())
    each = each.select("doc_id", F.coalesce("n", F.lit(0)).cast("long").alias("n_sentences"), F.coalesce("line_ids", F.lit("")).alias("sentence_ids"), F.array_join(both, ",").alias("licences"))
    return docs.select("doc_id").hint("merge").join(each, "doc_id", "left").select("doc_id", F.coalesce("n_sentences", F.lit(0).cast("long")).alias("n_sentences"), F.coalesce("sentence_ids", F.lit("")).alias("sentence_ids"), F.coalesce("licences", F.lit("")).alias("licences"))


def oracle(table: str = "documents") -> str:
    """DuckDB SQL for ``scan``: every text is cut, and the runs are taken out one after the other by nested ``replace``."""
    said = ", ".join(f"({i}, '{s}')" for i, s in SENTENCES)
    left, has = "c", {name: [] for name in NAMES}
    for name, rule in RUNS:
        has[name].append(f"contains({left}, '{_held(rule)}')")
        left = f"replace({left}, '{_held(rule)}', '#')"
    for name, rules in ALONE:
        has[name] += [f"contains({left}, '<{r}>')" for r in rules]
    held = "'<' || replace({0}, ',', '><') || '>'"
    flags = ", ".join(f"list_bool_or([{', '.join(x)}]) AS f{i}" for i, x in enumerate(has.values()))
    found = ", ".join(f"CASE WHEN a.f{i} OR b.f{i} THEN '{name}' END" for i, name in enumerate(has))
    return f"""
WITH known(id, said) AS (VALUES {said}),
cut AS (
  SELECT doc_id, 0 AS way, regexp_split_to_array(coalesce(text, ''), '[.!?]+[ \\t\\r\\n]+|[\\r\\n]+') AS p FROM {table}
  UNION ALL
  SELECT doc_id, 1, regexp_split_to_array(coalesce(text, ''), '[.!?]+[ \\t\\r\\n]+|\\n[ \\t\\r]*\\n') FROM {table}),
piece AS (SELECT doc_id, way, unnest(p) AS s, unnest(range(len(p))) AS pos FROM cut),
hit AS (SELECT doc_id, way, pos, id FROM piece JOIN known ON trim(regexp_replace(lower(s), '[^a-z0-9]+', ' ', 'g')) = said),
seq AS (SELECT doc_id, coalesce(count(*) FILTER (way = 0), 0) AS n,
  coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos) FILTER (way = 0), '') AS line_ids,
  coalesce(string_agg(CAST(id AS VARCHAR), ',' ORDER BY pos) FILTER (way = 1), '') AS text_ids FROM hit GROUP BY doc_id),
ids AS (SELECT DISTINCT line_ids AS ids FROM seq UNION SELECT text_ids FROM seq),
told AS (SELECT ids, {flags} FROM (SELECT ids, {held.format("ids")} AS c FROM ids))
SELECT d.doc_id, CAST(coalesce(n, 0) AS BIGINT) AS n_sentences, coalesce(line_ids, '') AS sentence_ids,
  coalesce(concat_ws(',', {found}), '') AS licences
FROM {table} d LEFT JOIN seq ON d.doc_id = seq.doc_id LEFT JOIN told a ON a.ids = line_ids LEFT JOIN told b ON b.ids = text_ids"""
