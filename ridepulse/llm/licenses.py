"""License scans by sentence rules.

A text is cut into sentences, each normalised and looked up among known
licence sentences, else among the known sentences with open parts; the document's sequence of sentence identifiers is then
matched against ordered licence rules. A rule is a run of identifiers; it
takes those it matches out of the sequence, so a longer rule that comes first
is not reported again as its parts.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# Known licence sentences, normalised, and their identifiers.
SENTENCES = {
    "licensed under the apache license version 2.0": "Apache2Notice",
    "licensed under the apache license version 2.0 the license": "Apache2Notice",
    "you may not use this file except in compliance with the license": "ApacheCompliance",
    "you may obtain a copy of the license at http www.apache.org licenses license-2.0": "Apache2Copy",
    "see the license for the specific language governing permissions and limitations under the license": "ApacheSee",
    "released under the mit license": "MITNotice",
    "licensed under the mit license": "MITNotice",
    "this project is licensed under the mit license": "MITNotice",
    "permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction including without limitation the rights to use copy modify merge publish distribute sublicense and or sell copies of the software and to permit persons to whom the software is furnished to do so subject to the following conditions": "MITGrant",
    "the above copyright notice and this permission notice shall be included in all copies or substantial portions of the software": "MITCondition",
    "the software is provided as is without warranty of any kind express or implied including but not limited to the warranties of merchantability fitness for a particular purpose and noninfringement": "MITWarranty",
    "this work is licensed under the gnu general public license version 3": "GPL3Notice",
    "licensed under the gnu general public license version 3": "GPL3Notice",
    "licensed under the gnu general public license version 2": "GPL2Notice",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 3 of the license or at your option any later version": "GPL3Plus",
    "this program is free software you can redistribute it and or modify it under the terms of the gnu general public license as published by the free software foundation either version 2 of the license or at your option any later version": "GPL2Plus",
    "see the gnu general public license for more details": "GPLSee",
    "licensed under the gnu lesser general public license version 3": "LGPL3Notice",
    "licensed under cc by-nc 4.0": "CCBYNC4Notice",
    "licensed under cc by-nc-sa 4.0": "CCBYNCSA4Notice",
    "licensed under cc by-sa 4.0": "CCBYSA4Notice",
    "licensed under cc by 4.0": "CCBY4Notice",
    "this work is licensed under a creative commons attribution 4.0 international license": "CCBY4Notice",
    "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met": "BSDGrant",
    "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer": "BSDSource",
    "redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution": "BSDBinary",
    "this source code form is subject to the terms of the mozilla public license v 2.0": "MPL2Notice",
    "licensed under the mozilla public license version 2.0": "MPL2Notice",
    "this is free and unencumbered software released into the public domain": "Unlicense",
    "permission to use copy modify and or distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
    "all rights reserved": "AllRights",
    "licensed under the gnu affero general public license version 3": "AGPL3Notice",
    "this work is licensed under the gnu affero general public license version 3": "AGPL3Notice",
    "licensed under the gnu lesser general public license version 2.1": "LGPL21Notice",
    "see the gnu affero general public license for more details": "AGPLSee",
    "see the gnu lesser general public license for more details": "LGPLSee",
    "neither the name of the copyright holder nor the names of its contributors may be used to endorse or promote products derived from this software without specific prior written permission": "BSDEndorse",
    "this source code form is subject to the terms of the mozilla public license v": "MPL2Notice",
    "permission to use copy modify and distribute this software for any purpose with or without fee is hereby granted provided that the above copyright notice and this permission notice appear in all copies": "ISCGrant",
}
_GPL = "is free software you can redistribute it and or modify it under the terms of the gnu "
_BY_FSF = "general public license as published by the free software foundation(?: inc)? either version "
_LATER = " of the license or at your option any later version"
_ONLY = "general public license(?: as published by the free software foundation(?: inc)?)?(?: either)? version "
_BSD_GRANT = "redistribution and use in source and binary forms with or without modification are permitted provided that the following conditions are met"
_BSD_SOURCE = "redistributions of source code must retain the above copyright notice this list of conditions and the following disclaimer"
# Sentences with open parts (a name, a list mark, what stands before without a full stop), as
# expressions on the normalised sentence; the first that is found in a sentence that is not in SENTENCES counts.
PATTERNS = [
    (r"\blicensed under the apache license version 2\.0(?: the license)? you may not use this file except in compliance with the license\b", "Apache2Joined"),
    (_BSD_GRANT + r".*" + _BSD_SOURCE, "BSDGrantSource"),
    (_BSD_GRANT, "BSDGrant"),
    (_BSD_SOURCE, "BSDSource"),
    (r"redistributions in binary form must reproduce the above copyright notice this list of conditions and the following disclaimer in the documentation and or other materials provided with the distribution", "BSDBinary"),
    (r"\ball advertising materials mentioning features or use of this software must display the following acknowledge?ment", "BSDAdvert"),
    (r"\b(?:the names? of .*|nor the names of (?:its|their|any) .*)may (?:not )?be used to endorse or promote products derived from this software without (?:specific )?prior written permission", "BSDEndorse"),
    (r"permission is hereby granted free of charge to any person obtaining a copy of this software and associated documentation files the software to deal in the software without restriction .* subject to the following conditions", "MITGrant"),
    *[(_GPL + kind + _BY_FSF + v.replace(".", r"\.") + _LATER, name + "Plus")
      for kind, v, name in [("", "3", "GPL3"), ("", "2", "GPL2"), ("affero ", "3", "AGPL3"), ("lesser ", "3", "LGPL3"), ("lesser ", "2.1", "LGPL21"), ("library ", "2", "LGPL2")]],
    *[(_GPL + kind + _ONLY + v.replace(".", r"\.") + r"(?![.0-9])(?!.* any later version)", name + "Notice")
      for kind, v, name in [("", "3", "GPL3"), ("", "2", "GPL2"), ("affero ", "3", "AGPL3"), ("lesser ", "3", "LGPL3"), ("lesser ", "2.1", "LGPL21"), ("library ", "2", "LGPL2")]],
]
# Every sentence with open parts holds one of these.
_OPEN = "under the apache license|free software you can|redistribution|advertising materials|to endorse or promote|is hereby granted"
# Licence rules in the order they are tried.
RULES = [
    ("Apache-2.0", ["Apache2Notice", "ApacheCompliance", "Apache2Copy", "ApacheSee"]),
    ("Apache-2.0", ["Apache2Notice", "ApacheCompliance"]),
    ("Apache-2.0", ["Apache2Joined", "Apache2Copy", "ApacheSee"]),
    ("Apache-2.0", ["Apache2Joined", "ApacheSee"]),
    ("Apache-2.0", ["Apache2Joined"]),
    ("MIT", ["MITGrant", "MITCondition", "MITWarranty"]),
    ("MIT", ["MITGrant", "MITCondition"]),
    ("MIT", ["MITGrant", "MITWarranty"]),
    ("MIT", ["MITGrant"]),
    ("BSD-4-Clause", ["BSDGrant", "BSDSource", "BSDBinary", "BSDAdvert", "BSDEndorse"]),
    ("BSD-4-Clause", ["BSDGrantSource", "BSDBinary", "BSDAdvert", "BSDEndorse"]),
    ("BSD-3-Clause", ["BSDGrant", "BSDSource", "BSDBinary", "BSDEndorse"]),
    ("BSD-3-Clause", ["BSDGrantSource", "BSDBinary", "BSDEndorse"]),
    ("BSD-2-Clause", ["BSDGrant", "BSDSource", "BSDBinary"]),
    ("BSD-2-Clause", ["BSDGrantSource", "BSDBinary"]),
    ("AGPL-3.0-or-later", ["AGPL3Plus", "AGPLSee"]),
    ("LGPL-3.0-or-later", ["LGPL3Plus", "LGPLSee"]),
    ("LGPL-2.1-or-later", ["LGPL21Plus", "LGPLSee"]),
    ("AGPL-3.0-or-later", ["AGPL3Plus"]),
    ("LGPL-3.0-or-later", ["LGPL3Plus"]),
    ("LGPL-2.1-or-later", ["LGPL21Plus"]),
    ("LGPL-2.0-or-later", ["LGPL2Plus"]),
    ("GPL-3.0-or-later", ["GPL3Plus", "GPLSee"]),
    ("GPL-2.0-or-later", ["GPL2Plus", "GPLSee"]),
    ("GPL-3.0-or-later", ["GPL3Plus"]),
    ("GPL-2.0-or-later", ["GPL2Plus"]),
    ("Apache-2.0", ["Apache2Notice"]),
    ("MIT", ["MITNotice"]),
    ("GPL-3.0-only", ["GPL3Notice"]),
    ("GPL-2.0-only", ["GPL2Notice"]),
    ("LGPL-3.0-only", ["LGPL3Notice"]),
    ("AGPL-3.0-only", ["AGPL3Notice"]),
    ("LGPL-2.1-only", ["LGPL21Notice"]),
    ("LGPL-2.0-only", ["LGPL2Notice"]),
    ("CC-BY-NC-4.0", ["CCBYNC4Notice"]),
    ("CC-BY-NC-SA-4.0", ["CCBYNCSA4Notice"]),
    ("CC-BY-SA-4.0", ["CCBYSA4Notice"]),
    ("CC-BY-4.0", ["CCBY4Notice"]),
    ("MPL-2.0", ["MPL2Notice"]),
    ("Unlicense", ["Unlicense"]),
    ("ISC", ["ISCGrant"]),
]
# Every known sentence holds one of these; texts without any are not cut into sentences.
TRIGGER = "(?i)licen|permi|software|redistribution|all rights"

_SPACE = r"[ \t\r\f]+"


def _normal(sentence: Column) -> Column:
    words = F.trim(F.regexp_replace(F.lower(sentence), r"[^a-z0-9.+-]+", " "))
    return F.trim(F.regexp_replace(words, r"[.]+$|[.]+( )", "$1"))


def _identifiers(sentences: Column) -> Column:
    """The sequence of known sentences as ``,A,,B,``."""
    known = F.create_map(*[F.lit(x) for pair in SENTENCES.items() for x in pair])
    read = lambda s: F.when(s.rlike(_OPEN), F.coalesce(*[F.when(s.rlike(p), F.lit(i)) for p, i in PATTERNS]))
    found = F.transform(F.transform(sentences, _normal), lambda s: F.coalesce(F.try_element_at(known, s), read(s)))
    ids = F.filter(found, lambda i: i.isNotNull())
    return F.array_join(F.transform(ids, lambda i: F.concat(F.lit(","), i, F.lit(","))), "")


def _matched(sequence: Column) -> tuple[Column, Column]:
    """(licences in rule order, what no rule took)."""
    found = []
    for name, ids in RULES:
        run = "".join(f",{i}," for i in ids)
        found.append(F.when(F.contains(sequence, F.lit(run)), F.lit(name)))
        sequence = F.replace(sequence, F.lit(run), F.lit(""))
    return F.array_distinct(F.array_compact(F.array(*found))), sequence


def scan(docs: DataFrame) -> DataFrame:
    """doc_id, sentences, licenses, unmatched for every row of ``docs`` (doc_id, text; others are ignored).

    A sentence ends at a line's end or at . ! ? before a blank (``lines``); a
    second reading joins the lines of a paragraph first, for sentences that
    are wrapped (``flow``). ``sentences`` holds both readings' identifier
    sequences, ``licenses`` the licences either gives in rule order, comma
    between them, ``unmatched`` the identifiers of the first reading that no
    rule took. All are empty strings where nothing is known, also for null and
    empty texts. Equal rows stay as many rows.
    """
    text = F.coalesce(F.when(F.col("text").rlike(TRIGGER), F.col("text")), F.lit(""))
    ends = lambda t: F.split(F.regexp_replace(t, r"([.!?])[ \t\r\f]+", "$1\n"), "\n")
    flow = F.regexp_replace(F.regexp_replace(text, r"\n[ \t\r\f]*\n", ".\n\n"), r"([^\n])\n([^\n])", "$1 $2")
    rows = docs.select(
        F.col("doc_id").cast("long").alias("doc_id"), _identifiers(ends(text)).alias("_lines"), _identifiers(ends(flow)).alias("_flow")
    )
    (by_line, rest), (by_flow, _) = _matched(F.col("_lines")), _matched(F.col("_flow"))
    # a column of its own: every name below looks into it
    rows = rows.withColumn("_both", F.array_union(by_line, by_flow))
    both = F.col("_both")
    order = list(dict.fromkeys(name for name, _ in RULES))
    names = F.concat_ws(",", *[F.when(F.array_contains(both, n), F.lit(n)) for n in order])
    trim = lambda c: F.trim(F.replace(c, F.lit(",,"), F.lit(",")), F.lit(","))
    return rows.select(
        "doc_id",
        F.concat_ws("|", trim(F.col("_lines")), trim(F.col("_flow"))).alias("sentences"),
        names.alias("licenses"),
        trim(rest).alias("unmatched"),
    )
