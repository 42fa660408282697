"""License scans by sentence rules.

Texts are cut into normalised sentences, each known sentence that stands in one of
them becomes its identifier, and the sequence of identifiers in a text is matched
against ordered rules.  Only DataFrame functions are used; no text meets another, so the scan has
no shuffle beyond the small table of identifiers.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Sentence identifier, and the sentence in normal form.
SENTENCES = {
    "mit-released": "released under the mit license",
    "mit-grant": "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction",
    "mit-notice": "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software",
    "mit-warranty": "the software is provided as is without warranty of any kind express or implied",
    "apache-short": "licensed under the apache license version 2 0",
    "apache-may-not": "you may not use this file except in compliance with the license",
    "apache-copy": "you may obtain a copy of the license at",
    "apache-basis": "unless required by applicable law or agreed to in writing software distributed under the license is distributed on an as is basis",
    "gpl3-short": "this work is licensed under the gnu general public license version 3",
    "gpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation",
    "gpl-hope": "this program is distributed in the hope that it will be useful but without any warranty",
    "cc-by-nc-short": "licensed under cc by nc 4 0",
    "bsd-redistribution": "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met",
    "bsd-endorse": "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission",
    "bsd-warranty": "this software is provided by the copyright holders and contributors as is",
    "mpl-subject": "this source code form is subject to the terms of the mozilla public license v",
    "mpl-obtain": "if a copy of the mpl was not distributed with this file you can obtain one at",
    "lgpl-free": "this library is free software you can redistribute it and or modify it under the terms of the gnu lesser general public license as published by the free software foundation",
    "lgpl-hope": "this library is distributed in the hope that it will be useful but without any warranty",
    "agpl-free": "this program is free software you can redistribute it and or modify it under the terms of the gnu affero general public license as published by the free software foundation",
    "isc-permission": "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies",
    "isc-warranty": "the software is provided as is and the author disclaims all warranties with regard to this software",
    "unlicense-domain": "this is free and unencumbered software released into the public domain",
    "unlicense-anyone": "anyone is free to copy modify publish use compile sell or distribute this software",
    "cc0-dedicated": "has dedicated the work to the public domain by waiving all of his or her rights to the work worldwide under copyright law",
    "cc-by-short": "licensed under a creative commons attribution 4 0 international license",
    "cc-by-sa-short": "licensed under a creative commons attribution sharealike 4 0 international license",
    "boost-permission": "permission is hereby granted free of charge to any person or organization obtaining a copy of the software and accompanying documentation covered by this license the software to use reproduce display distribute execute and transmit the software",
    "zlib-warranty": "this software is provided as is without any express or implied warranty",
    "zlib-permission": "permission is granted to anyone to use this software for any purpose including commercial applications and to alter it and redistribute it freely",
    "epl-available": "this program and the accompanying materials are made available under the terms of the eclipse public license 2 0",
}

# Licence, and the sentence identifiers that must follow each other in this order.
RULES = [
    ("MIT", ["mit-released"]),
    ("MIT", ["mit-grant", "mit-notice", "mit-warranty"]),
    ("Apache-2.0", ["apache-short"]),
    ("Apache-2.0", ["apache-may-not", "apache-copy", "apache-basis"]),
    ("GPL-3.0", ["gpl3-short"]),
    ("GPL", ["gpl-free", "gpl-hope"]),
    ("CC-BY-NC-4.0", ["cc-by-nc-short"]),
    ("BSD", ["bsd-redistribution", "bsd-warranty"]),
    ("BSD-3-Clause", ["bsd-redistribution", "bsd-endorse", "bsd-warranty"]),
    ("MPL-2.0", ["mpl-subject", "mpl-obtain"]),
    ("LGPL", ["lgpl-free", "lgpl-hope"]),
    ("AGPL", ["agpl-free", "gpl-hope"]),
    ("ISC", ["isc-permission", "isc-warranty"]),
    ("Unlicense", ["unlicense-domain", "unlicense-anyone"]),
    ("CC0-1.0", ["cc0-dedicated"]),
    ("CC-BY-4.0", ["cc-by-short"]),
    ("CC-BY-SA-4.0", ["cc-by-sa-short"]),
    ("BSL-1.0", ["boost-permission"]),
    ("Zlib", ["zlib-warranty", "zlib-permission"]),
    ("EPL-2.0", ["epl-available"]),
]

# Further wordings of the sentences above.
VERSIONS = {
    "mit-notice": ["the above copyright notice and this permission notice including the next paragraph shall be included in all copies or substantial portions of the software"],
    "bsd-endorse": [f"neither the name of the {who} nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission" for who in ("copyright holders", "author", "organization", "university")],
    "mpl-subject": [f"this source code form is subject to the terms of the mozilla public license {v} 2 0" for v in ("v", "version")],
    "epl-available": [f"this program and the accompanying materials are made available under the terms of the eclipse public license v{v}" for v in ("", " 2 0", "2 0")],
    "bsd-warranty": [f"this software is provided by the {who} as is" for who in ("copyright holder and contributors", "author", "author and contributors", "regents and contributors")],
}

# A sentence ends at a blank line, or at . ! ? before white space or the end.
SENTENCE_END = r"(?:\r?\n|\r(?!\n))[ \t\f\x0B]*(?:\r?\n|\r(?!\n))|[.!?]+(?:\s|$)"

# What stands straight before a known sentence, in normal form, and turns it round.
DENIED = r"\b(?:not|cannot|never|neither|nor|no longer|[a-z]{1,7}n t)(?: yet| currently| also)?(?: been| being| be)? "


def known_forms(known: dict[str, str]) -> dict[str, str]:
    """Every wording with its identifier, the longest first, where one begins another."""
    names = {form: name for name, s in known.items() for form in (s, *VERSIONS.get(name, []))}
    return dict(sorted(names.items(), key=lambda x: (-len(x[0]), x[0])))


def sentence_ids(text: Column, known: dict[str, str]) -> Column:
    """Identifiers of the known sentences of a text, in their order.

    A sentence's normal form is lower case with every run of characters other than a-z
    and 0-9 as one space.  Known sentences are also found inside longer ones, unless
    denied there, as in "not released under ...".
    """
    names = known_forms(known)
    table = F.create_map(*[F.lit(x) for form, name in names.items() for x in (form, name)])
    # A filter on a cheap test first keeps the search to plausible sentences.
    openings = sorted({"[^a-z0-9]+".join(form.split(" ")[:2]) for form in names})
    cut = F.split(F.lower(F.coalesce(text, F.lit(""))), SENTENCE_END)
    plausible = F.filter(cut, lambda s: F.rlike(s, F.lit("(?<![a-z0-9])(?:" + "|".join(openings) + r")(?![a-z0-9])")))
    normal = F.transform(plausible, lambda s: F.regexp_replace(s, "[^a-z0-9]+", " "))
    forms = rf"\b(?<!{DENIED})(?:" + "|".join(names) + r")\b"
    found = F.flatten(F.transform(normal, lambda s: F.regexp_extract_all(s, F.lit(forms), F.lit(0))))
    return F.transform(found, lambda s: table[s])


def scan_licences(
    docs: DataFrame,
    known: dict[str, str] = SENTENCES,
    rules: list[tuple[str, list[str]]] = RULES,
) -> DataFrame:
    """(doc_id, sentence_ids, licences, n_rules) for every row of ``docs``.

    A rule holds when its identifiers occur one straight after another in the
    text's identifier sequence; other sentences may stand between them.  ``licences``
    has the distinct licences of the rules that hold, sorted.  A null or empty
    text, or one without a known sentence, has empty arrays.  Repeated rows give
    repeated results; other columns of ``docs`` are not read.
    """
    found = docs.select("doc_id", sentence_ids(F.col("text"), known).alias("sentence_ids"))
    joined = F.concat(F.lit("|"), F.concat_ws("|", "sentence_ids"), F.lit("|"))
    held = F.array(*[F.when(F.contains(joined, F.lit("|" + "|".join(ids) + "|")), F.lit(name)) for name, ids in rules])
    return found.withColumn("_held", F.filter(held, lambda x: x.isNotNull())).select(
        "doc_id",
        "sentence_ids",
        F.array_sort(F.array_distinct("_held")).alias("licences"),
        F.size("_held").cast("long").alias("n_rules"),
    )
