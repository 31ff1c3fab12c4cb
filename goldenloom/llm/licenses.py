"""License scans (10): positional rare-token index.

A document that holds a template holds all words of its key phrases, so its own licence words of the highest inverse document
frequency among them are the template's rare tokens, the same in every document. They are looked up in each document, joined
with their postings (template, place in it), and grouped by the difference of the two places; where enough rare tokens
agree on it, all of the template's key phrases are verified at that very place. Templates are notices and whole licence
texts; a score is the share of a template's words that stand where it puts them. DataFrame and SQL functions only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from goldenloom.llm.common import join_on, table
from goldenloom.llm.quality import let, text_of_sql

# Label, phrase.
PHRASES = (("cc-by", "cc by"), ("gpl", "general public license"), ("reserved", "all rights reserved"))
# Label, template words, and the key phrases (parted by |) that must stand where the template puts them.
TEMPLATES = (
    ("apache-2.0", "licensed under the apache license version 2 0", "apache license version 2 0"),
    ("gpl-3.0", "licensed under the gnu general public license version 3", "gnu general public license version 3"),
    ("gpl-2.0", "licensed under the gnu general public license version 2", "gnu general public license version 2"),
    ("lgpl", "licensed under the gnu lesser general public license", "gnu lesser general public license"),
    ("mit", "licensed under the mit license", "under the mit license"),
    ("mit", "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files", "permission is hereby granted free of charge"),
    ("bsd", "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met", "redistribution and use in source and binary forms"),
    ("mpl-2.0", "this source code form is subject to the terms of the mozilla public license v 2 0", "mozilla public license v 2 0"),
    ("isc", "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted", "copy modify and or distribute this software for any purpose"),
    ("cc-by-nc-4.0", "licensed under cc by nc 4 0", "cc by nc 4 0"),
    ("cc-by-sa-4.0", "licensed under cc by sa 4 0", "cc by sa 4 0"),
    ("cc-by-4.0", "licensed under cc by 4 0", "cc by 4 0"),
    (
        "mit",
        "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software "
        "without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit "
        "persons to whom the software is furnished to do so subject to the following conditions the above copyright notice and this permission notice shall be included in all "
        "copies or substantial portions of the software the software is provided as is without warranty of any kind express or implied including but not limited to the "
        "warranties of merchantability fitness for a particular purpose and noninfringement in no event shall the authors or copyright holders be liable for any claim damages "
        "or other liability whether in an action of contract tort or otherwise arising from out of or in connection with the software or the use or other dealings in the software",
        "merge publish distribute sublicense|shall be included in all copies or substantial portions",
    ),
    (
        "bsd-3-clause",
        "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met 1 redistributions of source "
        "code must retain the above copyright notice this list of conditions and the following disclaimer 2 redistributions in binary form must reproduce the above copyright "
        "notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution 3 neither the name of the "
        "copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
        "redistributions of source code must retain|nor the names of its contributors may be used to endorse or promote",
    ),
    (
        "isc",
        "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this "
        "permission notice appear in all copies the software is provided as is and the author disclaims all warranties with regard to this software including all implied "
        "warranties of merchantability and fitness",
        "copyright notice and this permission notice appear in all copies|the author disclaims all warranties",
    ),
    (
        "zlib",
        "this software is provided as is without any express or implied warranty in no event will the authors be held liable for any damages arising from the use of this "
        "software permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely subject to "
        "the following restrictions 1 the origin of this software must not be misrepresented you must not claim that you wrote the original software",
        "to alter it and redistribute it freely|the origin of this software must not be misrepresented",
    ),
    (
        "unlicense",
        "this is free and unencumbered software released into the public domain anyone is free to copy modify publish use compile sell or distribute this software either in "
        "source code form or as a compiled binary for any purpose commercial or non commercial and by any means",
        "free and unencumbered software released into the public domain",
    ),
    (
        "apache-2.0",
        "licensed under the apache license version 2 0 the license you may not use this file except in compliance with the license you may obtain a copy of the license at http "
        "www apache org licenses license 2 0 unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis "
        "without warranties or conditions of any kind either express or implied see the license for the specific language governing permissions and limitations under the license",
        "use this file except in compliance with the license|governing permissions and limitations under the license",
    ),
    (
        "gpl-3.0-or-later",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation "
        "either version 3 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty",
        "gnu general public license as published by the free software foundation|either version 3 of the license or at your option any later version",
    ),
    (
        "gpl-2.0-or-later",
        "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation "
        "either version 2 of the license or at your option any later version this program is distributed in the hope that it will be useful but without any warranty",
        "gnu general public license as published by the free software foundation|either version 2 of the license or at your option any later version",
    ),
)
RARE = 3
AGREE = 2
GAP = r"[\\x00-\\x2F\\x3A-\\x60\\x7B-\\x7F]+"
ANY_CASE_GAP = r"[\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
ANY_CASE_WORD = r"[^\\x00-\\x2F\\x3A-\\x40\\x5B-\\x60\\x7B-\\x7F]+"
_UPPER, _LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def _array(values) -> str:
    return f"array({', '.join(repr(v) for v in values)})"


def rare_tokens(docs: DataFrame, text_col: str = "text", templates=TEMPLATES, rare: int = RARE) -> list[list[str]]:
    """For each template the `rare` words of its key phrases of highest inverse document frequency over all
    docs, ties by word.
    The driver gets one count for each template word."""
    vocabulary = sorted({w for _, words, _ in templates for w in words.split()})
    held = docs.select(F.explode(F.expr(f"array_intersect(split(lower(cast(`{text_col}` as string)), '{GAP}'), {_array(vocabulary)})")).alias("word"))
    df = {r["word"]: r["n"] for r in held.groupBy("word").agg(F.count("*").alias("n")).collect()}
    return [sorted(set(key.replace("|", " ").split()), key=lambda w: (df.get(w, 0), w))[:rare] for *_, key in templates]


def scan(docs: DataFrame, rare: list[list[str]], id_col: str = "doc_id", text_col: str = "text", phrases=PHRASES) -> DataFrame:
    """(id, text_hash, n_words, base, w): base is an array of struct(i, label) of the phrases' places; w the
    words of texts that hold a rare token or a phrase, else null."""
    # A key phrase never stands without its rarest token. Short ones must be whole words.
    alone = lambda w: w if len(w) > 3 else f"(?<![0-9A-Za-z]){w}(?![0-9A-Za-z])"
    wanted = sorted({alone(words[0]) for words in rare} | {p.replace(" ", ANY_CASE_GAP) for _, p in phrases}, key=lambda x: (-len(x), x))
    gate = f"t rlike '(?i){'|'.join(wanted)}'"
    words = f"filter(split(translate(t, '{_UPPER}', '{_LOWER}'), '{GAP}'), x -> x <> '')"
    places = []
    for label, phrase in phrases:
        stands = " and ".join(f"get(w, i + {k}) = '{x}'" if k else f"w[i] = '{x}'" for k, x in enumerate(phrase.split()))
        places.append(f"transform(filter(sequence(0, size(w) - 1), i -> {stands}), i -> named_struct('i', i, 'label', '{label}'))")
    none = "cast(array() as array<struct<i:int,label:string>>)"
    base = f"if(w is null or size(w) = 0, {none}, array_sort(concat({', '.join(places)})))"
    counted = f"cast(regexp_count(t, '{ANY_CASE_WORD}') as long)"
    row = let(text_of_sql(text_col), "t", let(f"if({gate}, {words}, cast(null as array<string>))", "w", f"named_struct('n', {counted}, 'base', {base}, 'w', w)"))
    return docs.select(F.col(id_col).alias("id"), F.xxhash64(text_col).alias("text_hash"), F.expr(row).alias("f")).select("id", "text_hash", F.col("f.n").alias("n_words"), "f.base", "f.w")


def templates_in(scanned: DataFrame, rare: list[list[str]], templates=TEMPLATES, agree: int = AGREE) -> DataFrame:
    """(id, text_hash, found): found is an array of struct(label, score), a place's share of template words;
    only for documents in which a template's key phrases are verified."""
    spark = scanned.sparkSession
    rows = [(k, w, i) for k, (_, words, _) in enumerate(templates) for i, w in enumerate(words.split()) if w in rare[k]]
    postings = F.broadcast(spark.createDataFrame(rows, "k int, word string, at int"))  # as many rows as templates have words
    listed = _array(sorted({w for _, w, _ in rows}))
    held = scanned.where("w is not null").dropDuplicates(["id", "text_hash"])
    tokens = held.select("id", "text_hash", F.explode(F.expr(f"filter(transform(w, (x, i) -> named_struct('word', x, 'i', i)), x -> array_contains({listed}, x.word))")).alias("x"))
    aligned = tokens.select("id", "text_hash", "x.word", "x.i").join(postings, "word").groupBy("id", "text_hash", "k", F.expr("i - at").alias("start")).agg(F.count_distinct("word").alias("n"))
    need = f"least({agree}, element_at({_array([len(r) for r in rare])}, k + 1))"
    places = aligned.where(F.expr(f"n >= {need}")).groupBy("id", "text_hash").agg(F.collect_list(F.struct("k", "start")).alias("places"))
    every = f"array({', '.join(_array(words.split()) for _, words, _ in templates)})"
    part = lambda words, key: f"named_struct('at', {len(words[: words.index(key)].split())}, 'w', {_array(key.split())})"
    keys = f"array({', '.join('array(' + ', '.join(part(words, key) for key in keys.split('|')) + ')' for _, words, keys in templates)})"
    labels = _array([label for label, *_ in templates])
    keyed = f"forall(element_at({keys}, p.k + 1), q -> p.start + q.at >= 0 and slice(w, p.start + q.at + 1, size(q.w)) = q.w)"
    share = let(f"element_at({every}, p.k + 1)", "tw", "size(filter(transform(tw, (x, i) -> p.start + i >= 0 and get(w, p.start + i) = x), y -> y)) / size(tw)")
    verified = f"transform(filter(places, p -> {keyed}), p -> named_struct('label', element_at({labels}, p.k + 1), 'score', {share}))"
    return join_on(held, places, ["id", "text_hash"]).select("id", "text_hash", F.expr(verified).alias("found")).where(F.size("found") > 0)


def license_scan(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", templates=TEMPLATES) -> DataFrame:
    """Per document: id, n_words, n_base, first_word, last_word, base_labels, labels, score (the largest share
    of a verified template's words in place, 0 if none is verified).

    A null or empty text has no words and no labels; repeated rows give repeated rows; an empty table gives
    an empty one; other columns are ignored."""
    rare = rare_tokens(docs, text_col, templates)
    scanned = table(scan(docs, rare, id_col, text_col), "license-words")
    found = table(templates_in(scanned, rare, templates), "license-templates")
    labels = lambda x: f"array_join(array_sort(array_distinct({x})), ',')"
    extra = "coalesce(transform(found, x -> x.label), cast(array() as array<string>))"
    return join_on(scanned, found, ["id", "text_hash"], "left").select(
        F.col("id").alias(id_col), "n_words", F.expr("cast(size(base) as long) as n_base"),
        F.expr("cast(array_min(transform(base, x -> x.i)) as long) as first_word"), F.expr("cast(array_max(transform(base, x -> x.i)) as long) as last_word"),
        F.expr(f"{labels('transform(base, x -> x.label)')} as base_labels"), F.expr(f"{labels(f'concat(transform(base, x -> x.label), {extra})')} as labels"),
        F.expr("coalesce(array_max(transform(found, x -> x.score)), 0D) as score"))
