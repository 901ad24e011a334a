"""Folding, similarity, names, addresses and places in plain Python."""

import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from orgloom.llm.names import block_codes, likeness, parse_name, sound, word_likeness
from orgloom.llm.places import province_key, split_place
from orgloom.llm.setjoin import grams
from orgloom.llm.streets import parse_address
from orgloom.llm.text import edits, fold, jaro_winkler


def test_fold():
    assert fold("  Vîp es​ ") == "vip es" and fold("Gikаlmir") == "gikalmir"  # a Cyrillic а
    assert fold("") == ""


def test_jaro_winkler():
    assert jaro_winkler("martha", "marhta") == pytest.approx(0.9611, abs=1e-4)
    assert jaro_winkler("dixon", "dicksonx") == pytest.approx(0.8133, abs=1e-4)
    assert jaro_winkler("", "") == 0.0 and jaro_winkler("a", "") == 0.0 and jaro_winkler("ab", "ab") == 1.0


def full_edits(a, b):
    d = {(i, 0): i for i in range(len(a) + 1)} | {(0, j): j for j in range(len(b) + 1)}
    for i in range(1, len(a) + 1):
        for j in range(1, len(b) + 1):
            d[i, j] = min(d[i - 1, j] + 1, d[i, j - 1] + 1, d[i - 1, j - 1] + (a[i - 1] != b[j - 1]))
            if i > 1 and j > 1 and a[i - 1] == b[j - 2] and a[i - 2] == b[j - 1]:
                d[i, j] = min(d[i, j], d[i - 2, j - 2] + 1)
    return d[len(a), len(b)]


@settings(max_examples=200, deadline=None)
@given(st.text("abc", max_size=7), st.text("abc", max_size=7))
def test_edits_equal_the_full_table(a, b):
    assert edits(a, b, 3) == min(full_edits(a, b), 4)


@pytest.mark.parametrize(
    "name, purpose, given_, own",
    [
        ("Masjid Salman Grezutaix Jambavar", "mosque", "salman", ("grezutaix", "jambavar")),
        ("I.C. Hamzah Boparn Rimbontith", "centre", "hamza", ("boparn", "rimbontith")),
        ("M.A. of Saidur Khunainto", "association", "", ("saidur", "khunainto")),
        ("GraisaxGarvorvam Fndn. Ltd", "foundation", "", ("graisax", "garvorvam")),
        ("MOSQUÉE NONTAIK RÂISTABARN", "mosque", "", ("nontaik", "raistabarn")),
        ("Is lamic Centre of A. Belix", "centre", "", ("a", "belix")),
        ("Prayer Room", "musalla", "", ()),
        ("Unknown", "", "", ()),
        (None, "", "", ()),
        ("", "", "", ()),
    ],
)
def test_names(name, purpose, given_, own):
    assert parse_name(name) == (purpose, given_, own)


def test_place_behind_a_name():
    assert parse_name("Voukith Sandazoa Mosque of New Willalom", ("newwillalom",))[2] == ("voukith", "sandazoa")


def test_likeness():
    same = lambda a, b: likeness(parse_name(a)[2], parse_name(a)[1], parse_name(b)[2], parse_name(b)[1])
    assert same("Boparn Rimbontith Mosque", "Masjid Rimbontith Boparn") == 1.0
    assert same("B. Shavelox Centre", "Shavelox Brevadex Centre") > 0.8
    assert same("Masjid Hamza Aaret Bolim", "Masjid Omar Aaret Bolim") == 0.0
    assert same("Aaret Bolim School", "Cedrin Bolim School") == 0.0
    assert same("Mosque", "Mosque") == 0.0
    assert set(block_codes(("b", "shavelox"))) & set(block_codes(("brevadex", "shavelox")))
    assert sound("khallid") == sound("kalid")


@pytest.mark.parametrize(
    "raw, name, hint",
    [
        ("Traina (ON)", "traina", "ON"),
        ("BC - Khopadar", "khopadar", "BC"),
        ("Gusaindox, BC, Canada", "gusaindox", "BC"),
        ("New Coustu, British Columbia", "newcoustu", "BC"),
        ("City of  Port Pafes.", "portpafes", ""),
        ("E. Mirogok", "eastmirogok", ""),
        ("S ai cegal", "saicegal", ""),
        ("Torulur Torulur", "torulur", ""),
        ("port maishur Ontario", "portmaishur", "ON"),
        ("N/A", "", ""),
        (None, "", ""),
    ],
)
def test_cities(raw, name, hint):
    assert split_place(raw) == (name, hint)


def test_provinces():
    assert {province_key(x) for x in ("ON", "Ont.", "O.N.", "CA-ON", "Province of Ontario", "Ontario, Canada", "Ontario (ON)")} == {"ontario"}
    assert province_key("Nouvelle-Écosse") == "novascotia" and province_key("Any") == "" and province_key("Canada") == ""


@pytest.mark.parametrize(
    "address, parts",
    [
        ("Suite 210 - 3073, av. Vucitoux Sud", ("3073", "vucitoux", "avenue", "s")),
        ("465 E Divoulind Cresc.", ("465", "divoulind", "crescent", "e")),
        ("Divoulind Crescent East 313 (rear)", ("313", "divoulind", "crescent", "e")),
        ("2nd floor, 2145 Taivol way E, Khatogaa", ("2145", "taivol", "way", "e")),
        ("#1445 Jaizek Way East", ("1445", "jaizek", "way", "e")),
        ("356 Divulind East", ("356", "divulind", "", "e")),
        ("P.O. Box 1261 Stn A", None),
        ("RR 3", None),
        ("c/o mailbox", None),
        ("by appointment", None),
        ("Main Street", None),
        ("", None),
        (None, None),
    ],
)
def test_addresses(address, parts):
    assert parse_address(address, ("khatogaa",)) == parts


def test_grams_are_sets():
    assert len(grams("aaaa")) == len(set(grams("aaaa"))) == 4 + 5 + 4


@pytest.mark.parametrize("a, b", [("dumoudoum", "dumoundoum"), ("missisippi", "mississippi"), ("abcdefgh", "abcdefgxyzwh")])
def test_words_with_repeated_letters_or_long_endings_are_compared(a, b):
    assert word_likeness(a, b) >= jaro_winkler(a, b) > 0.8


@settings(max_examples=500, deadline=None)
@given(st.text("abcd", min_size=2, max_size=12), st.text("abcd", min_size=2, max_size=12))
def test_word_likeness_leaves_out_nothing_that_counts(a, b):
    short, long = sorted((a, b), key=len)
    full = 1.0 if a == b else 0.94 if len(short) > 2 and long.startswith(short) else jaro_winkler(a, b)
    if len(short) > 3 and full < 0.93:
        full = max(full, {1: 0.93, 2: 0.87 if len(short) > 6 else 0.0}.get(edits(a, b, 2), 0.0))
    got = word_likeness(a, b)
    assert got == pytest.approx(full) or (got == 0.0 and full < 0.8)
