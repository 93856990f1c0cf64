"""Small tables with the awkward cases: nulls, empty and long texts, ties, repeated rows."""

import os

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
PASSAGE = " ".join(f"p{i}{'xyz'[i % 3]}" for i in range(70))
NEAR = [f"n{i % 37}-{i}" for i in range(120)]

TEXTS = [
    None,
    "",
    "   \t\r\n ",
    "one",
    "one two three",
    PASSAGE,
    "Start here. " + PASSAGE + " end of it\nline\nline\n \nline",
    PASSAGE.upper(),
    " ".join(NEAR),
    " ".join(NEAR[:60] + ["changed"] + NEAR[61:]),
    " ".join(NEAR[:61] + ["other"] + NEAR[62:]),
    " ".join(NEAR),
    "mail a.b+c@x-y.example.org, c@d.e_f@g.h @x.y a@b IP 10.0.0.255 1.2.3.256 1.2.3.4.5.6.7.8 0001.2.3.4",
    "card 4111 1111 1111 1111 or 4111-1111-1111-1112 phone +49 (30) 1234567, +1 2, +12345678901234567 x4111111111111111y",
    "IBAN DE89 3704 0044 0532 0130 00 and GB82WEST12345698765432, wrong DE89370400440532013001.",
    "Licensed under the Apache License, Version 2.0. All rights reserved. GNU General Public License; CC-BY cc by",
    "a " * 3000,
    "é" * 2500 + " ß　x \x85y​z",
    "=" * 4000,
    "1" * 3000 + "." + "2" * 3000,
    "a@" * 500 + ("b." * 500) + "c",
    "#### $$$$ %%% && || <> ***",
    "'s don't  we'll\n\n  two   spaces \tTab 12345 ½ ٣",
    "Übung macht den Meister und die Meisterin auch",
    "x y z " * 40 + PASSAGE + " " + PASSAGE,
]


def rows():
    """(doc_id, text, lang, source, n_chars) with nulls in every column but doc_id."""
    langs, hosts = ["en", "de", None], ["h0", "h1", None]
    return [(i, t, langs[i % 3], hosts[i % 3], None if t is None else len(t)) for i, t in enumerate(TEXTS)]


SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
