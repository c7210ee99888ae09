"""Licence recognition by sentence rules, in DataFrame functions only.

A text is normalised as a whole to lower-case words, so that wrapped lines, comment marks and
padding make no difference. Known licence sentences are looked up in it as sequences of words,
longer ones first; the identifiers found, in order, are matched against licence rules. Rules
are ordered: what a rule has matched is not matched again by a later, shorter one. A sentence
counts wherever its words stand, also where the text goes on.

Defined results: null and empty texts have no sentences and no licence; texts of any length are
read whole; a licence found twice is listed once, in the order of the rules; rows are
independent; an empty table gives an empty table; other columns are ignored.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# fixed values: known licence sentences in normal form and their identifiers
SENTENCES = {
    "licensed under the apache license version 2 0": "apache_notice",
    "licensed under the apache license version 2 0 the license": "apache_notice",
    "you may not use this file except in compliance with the license": "apache_compliance",
    "you may obtain a copy of the license at http www apache org licenses license 2 0": "apache_copy",
    "released under the mit license": "mit_notice",
    "licensed under the mit license": "mit_notice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files": "mit_grant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "mit_condition",
    "the software is provided as is without warranty of any kind": "as_is",
    "this work is licensed under the gnu general public license version 3": "gpl3_notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "gpl3_terms",
    "this program is distributed in the hope that it will be useful but without any warranty": "gpl_no_warranty",
    "licensed under cc by nc 4 0": "cc_by_nc_notice",
    "licensed under cc by 4 0": "cc_by_notice",
    "licensed under cc by sa 4 0": "cc_by_sa_notice",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "bsd_conditions",
}
# fixed values: licences and the sentence sequences that show them, longer ones first
RULES = (
    ("Apache-2.0", ("apache_notice", "apache_compliance", "apache_copy")),
    ("Apache-2.0", ("apache_notice", "apache_compliance")),
    ("Apache-2.0", ("apache_notice",)),
    ("MIT", ("mit_grant", "mit_condition", "as_is")),
    ("MIT", ("mit_grant", "mit_condition")),
    ("MIT", ("mit_notice",)),
    ("GPL-3.0-or-later", ("gpl3_terms", "gpl_no_warranty")),
    ("GPL-3.0-or-later", ("gpl3_terms",)),
    ("GPL-3.0", ("gpl3_notice",)),
    ("CC-BY-NC-4.0", ("cc_by_nc_notice",)),
    ("CC-BY-SA-4.0", ("cc_by_sa_notice",)),
    ("CC-BY-4.0", ("cc_by_notice",)),
    ("BSD", ("bsd_conditions",)),
)

# fixed values: more wordings, and full ones of common licences
MORE_SENTENCES = {
    "you may obtain a copy of the license at https www apache org licenses license 2 0": "apache_copy",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "mit_grant",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "gpl2_terms",
    "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 2 1 of the license or at your option any later version": "lgpl21_terms",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation either version 3 of the license or at your option any later version": "lgpl3_terms",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation either version 3 of the license or at your option any later version": "agpl3_terms",
    "this library is distributed in the hope that it will be useful but without any warranty": "gpl_no_warranty",
    "this source code form is subject to the terms of the mozilla public license v 2 0": "mpl2_notice",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "isc_grant",
    "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license": "bsl_grant",
    "this is free and unencumbered software released into the public domain": "unlicense_notice",
    "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0": "epl2_notice",
}
# fixed values: their licences
MORE_RULES = (
    ("GPL-2.0-or-later", ("gpl2_terms", "gpl_no_warranty")),
    ("GPL-2.0-or-later", ("gpl2_terms",)),
    ("LGPL-2.1-or-later", ("lgpl21_terms", "gpl_no_warranty")),
    ("LGPL-2.1-or-later", ("lgpl21_terms",)),
    ("LGPL-3.0-or-later", ("lgpl3_terms", "gpl_no_warranty")),
    ("LGPL-3.0-or-later", ("lgpl3_terms",)),
    ("AGPL-3.0-or-later", ("agpl3_terms", "gpl_no_warranty")),
    ("AGPL-3.0-or-later", ("agpl3_terms",)),
    ("MPL-2.0", ("mpl2_notice",)),
    ("ISC", ("isc_grant",)),
    ("BSL-1.0", ("bsl_grant",)),
    ("Unlicense", ("unlicense_notice",)),
    ("EPL-2.0", ("epl2_notice",)),
)

# of the checking SQL, which knows sentences that stand alone on one line: their ends, and the
# length beyond which it reads none
SENTENCE_END = "[.!?]+([ \\t\\r\\n]|$)"
LONGEST = 2 * max(map(len, SENTENCES))
NOT_A_WORD = "[^a-z0-9]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# each known sentence has one of these words; texts without any are not normalised
CUES = "licen|software|warranty|redistribution"


def sequence_text(identifiers: tuple[str, ...]) -> str:
    return "".join(f",{i}," for i in identifiers)


def sentence_identifiers(text: Column) -> Column:
    """Identifiers of the known sentences of a text, in order."""
    sentences = SENTENCES | MORE_SENTENCES
    known = F.create_map(*[F.lit(x) for pair in sentences.items() for x in pair])
    any_of = "|".join(sorted(sentences, key=len, reverse=True))
    lowered = F.translate(text, UPPER, LOWER)
    normal = F.trim(F.regexp_replace(lowered, NOT_A_WORD, " "))
    found = F.regexp_extract_all(normal, F.lit(f"(?:^| )({any_of})(?= |$)"), F.lit(1))
    identifiers = F.transform(found, lambda s: F.try_element_at(known, s))
    return F.when(lowered.rlike(CUES), identifiers).otherwise(F.array().cast("array<string>"))


def scan_licences(docs: DataFrame, text: str = "text", keep: tuple[str, ...] = ("doc_id",)) -> DataFrame:
    """``n_sentences`` (known ones) and ``licences``, an array of names, of every text."""
    rules = F.array(
        *[F.struct(F.lit(name).alias("name"), F.lit(sequence_text(ids)).alias("ids")) for name, ids in RULES + MORE_RULES]
    )
    start = F.struct(
        F.array_join(F.transform("__found", lambda i: F.concat(F.lit(","), i, F.lit(","))), "").alias("rest"),
        F.array().cast("array<string>").alias("names"),
    )
    matched = F.aggregate(
        rules,
        start,
        lambda acc, rule: F.struct(
            # a mark in its place keeps what stood before and after apart
            F.replace(acc["rest"], rule["ids"], F.lit(",#,")).alias("rest"),
            F.when(
                F.contains(acc["rest"], rule["ids"]), F.array_union(acc["names"], F.array(rule["name"]))
            )
            .otherwise(acc["names"])
            .alias("names"),
        ),
        lambda acc: acc["names"],
    )
    kept = [F.col(c) for c in keep if c not in ("n_sentences", "licences")]
    found = docs.select(*kept, sentence_identifiers(F.col(text)).alias("__found"))
    names = [c for c in keep if c not in ("n_sentences", "licences")]
    return found.select(
        *names, F.size("__found").cast("long").alias("n_sentences"), matched.alias("licences")
    )
