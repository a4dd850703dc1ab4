"""op10: canonical form, whole texts, parts, odd rows."""

from __future__ import annotations

import re
import textwrap

import pytest

from pulsegrid.llm import license_scan as ls

MIT = ls.TEXTS["MIT"]


@pytest.mark.parametrize("text, whole, found", [
    (MIT, "MIT", ["MIT"]),
    ("The title\n\n" + MIT, None, []),
    ("Copyright (c) 2019 Some One\nCopyright 2020 Other\nAll rights reserved.\n" + MIT.upper().replace(",", " ;"), "MIT", ["MIT"]),
    (" ".join(MIT.split()).replace("sublicense", "sub-licence"), "MIT", ["MIT"]),
    (MIT.replace("free of charge", "for a fee"), None, []),
    ("some words\nReleased under the MIT Licence!\nmore", None, ["MIT"]),
    ("words released under the MIT License. words", None, []),
    ("a b\n\nLicensed under\nCC BY-NC 4.0\n\nReleased under the MIT License.", None, ["CC-BY-NC-4.0", "MIT"]),
    ("", None, []), (None, None, []), ("!!! ...\n\n", None, []),
])
def test_matches(spark, text, whole, found):
    df = spark.createDataFrame([(1, text, "x")], "doc_id long, text string, licenses string")
    row = ls.scan(df).collect()
    assert [(r.whole_license, r.licenses) for r in row] == [(whole, found)]


def test_repeated_rows_null_ids_and_empty_tables(spark):
    rows = [(None, "Released under the MIT License."), (2, None), (2, None), (3, "ISC License"), (3, "Licensed under ISC License")]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    got = sorted(((r.doc_id or -1, r.whole_license, r.n_parts) for r in ls.scan(df).collect()), key=str)
    assert got == sorted([(-1, "MIT", 1), (2, None, 0), (2, None, 0), (3, None, 0), (3, "ISC", 1)], key=str)
    assert ls.scan(df.limit(0)).count() == 0
    assert all(not r.licenses for r in ls.scan(df, known=[]).collect())


COPYRIGHT = "Copyright (c) 2024 Some One"


@pytest.mark.parametrize("licence, text", [
    ("MIT", f"MIT License\n\n{COPYRIGHT}\n{MIT}"),
    ("MIT", f"# The MIT License (MIT)\n\n{COPYRIGHT}\n{MIT}"),
    ("MIT", f"Copyright Some One and others\n{MIT}"),
    ("MIT", f"Copyright: <holder>\n{MIT}"),
    ("ISC", f"ISC License\n\nCopyright The Authors\n{ls.TEXTS['ISC']}"),
    ("ISC", ls.TEXTS["ISC"].replace("and/or", "and")),
    ("BSD-2-Clause", f"BSD 2-Clause License\n\n{COPYRIGHT}, All rights reserved.\n{ls.TEXTS['BSD-2-Clause']}"),
    ("BSD-3-Clause", f"BSD 3-Clause License\n\n{COPYRIGHT}\nAll rights reserved.\n{ls.TEXTS.get('BSD-3-Clause')}"),
    ("BSD-3-Clause", re.sub(r"(?m)^[0-9]\. ", "* ", ls.TEXTS.get("BSD-3-Clause", "")).replace("HOLDER OR", "OWNER OR")),
    ("Unlicense", ls.TEXTS.get("Unlicense")),
    ("Zlib", f"zlib License\n\n(C) 2020 Some One\n{ls.TEXTS['Zlib']}"),
])
def test_licence_files(spark, licence, text):
    row = ls.scan(spark.createDataFrame([(1, text)], "doc_id long, text string")).first()
    assert (row.whole_license, row.licenses) == (licence, [licence])


def test_texts_wrapped_at_any_width(spark):
    rows = [(k, "\n\n".join(textwrap.fill(" ".join(p.split()), width, break_long_words=False, break_on_hyphens=False) for p in v.strip().split("\n\n")))
            for k, v in ls.TEXTS.items() for width in range(20, 130)]
    got = ls.scan(spark.createDataFrame(rows, "doc_id string, text string")).collect()
    assert len(got) == len(rows) and all(r.whole_license == r.doc_id for r in got)
