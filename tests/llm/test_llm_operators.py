"""The matching, cleaning and mixing operators on small tables."""

import random

import pandas as pd
import pytest
from pyspark.sql import functions as F

from orgloom.llm import addresses, components, golden, locate, matching, mixing, names, places, setjoin, stuffing, variants

PLACES = "place_id int, kind string, name string, province string, alt_names array<string>, lat double, lng double"
LIST = [
    (1, "city", "Thaso", "ON", [], 46.9, -57.5),
    (2, "city", "Muvevur", "ON", ["Oldname"], 56.9, -127.1),
    (3, "city", "Muvevur", "QC", [], 44.9, -133.0),
    (4, "city", "Port Muvevur", "ON", [], 50.9, -85.8),
    (901, "province", "Ontario", "ON", ["Ont"], None, None),
    (902, "province", "Quebec", "QC", ["Que"], None, None),
]


@pytest.fixture(scope="module")
def ref(spark):
    return spark.createDataFrame(LIST, PLACES)


def test_components(spark, rows):
    random.seed(2)
    edges = [(random.randint(0, 60), random.randint(0, 60)) for _ in range(35)] + [(100 + i, 101 + i) for i in range(30)] + [(5, 5), (None, 1)]
    leader = {}

    def find(x):
        while leader.setdefault(x, x) != x:
            x = leader[x]
        return x

    for a, b in edges:
        if a is not None and a != b:
            ra, rb = find(a), find(b)
            leader[max(ra, rb)] = min(ra, rb)
    want = {x: find(x) for x in list(leader)}
    got = components.connected_components(spark.createDataFrame(edges, "a int, b int"), "a", "b")
    assert {r.node: r.component for r in got.collect()} == want
    assert components.connected_components(spark.createDataFrame([], "a int, b int"), "a", "b").count() == 0


def test_similar_keys_equal_brute_force(spark):
    random.seed(4)
    word = lambda: "".join(random.choices("abcde", k=random.randint(2, 9)))
    keys, entries = sorted({word() for _ in range(120)}), sorted({word() for _ in range(40)})
    frame = lambda ws: spark.createDataFrame([("k", w, setjoin.grams(w)) for w in ws], "kind string, key string, set array<string>")
    for t in (0.35, 0.6):
        want = {(k, e) for k in keys for e in entries if len(x := set(setjoin.grams(k)) & set(setjoin.grams(e))) / len(set(setjoin.grams(k)) | set(setjoin.grams(e))) >= t and x}
        got = [(r.key, r.entry) for r in setjoin.similar_keys(frame(keys), frame(entries), t).collect()]
        assert len(got) == len(set(got)) and set(got) == want


def test_places(spark, ref, rows):
    data = [
        ("a", "city", "Thsao", None, None, None),
        ("b", "city", "Muvevur, QC", "ON", None, None),
        ("c", "city", "muvevur", "Ontairo", None, None),
        ("d", "city", "Muvevur", None, 44.9, -133.0),
        ("e", "city", "Atlantis", None, None, None),
        ("f", "city", " ", None, None, None),
        ("g", "city", None, None, None, None),
        ("h", "city", "oldnmae", None, None, None),
        ("i", "city", "Pt. Muvevur", None, None, None),
        ("j", "province", "Ontairo", None, None, None),
        ("j", "province", "Ontairo", None, None, None),
        ("k", "province", "Not in list", None, None, None),
        ("l", "city", "x" * 20_000, None, None, None),
        ("m", "city", "Muvevur", None, None, None),
    ]
    df = spark.createDataFrame([(*d, "clash") for d in data], "record_id string, field string, text string, province string, lat double, lng double, place_id string")
    assert rows(places.map_to_places(df, ref)) == [("a", "city", 1), ("b", "city", 3), ("c", "city", 2), ("d", "city", 3), ("e", "city", 0), ("h", "city", 2), ("i", "city", 4), ("j", "province", 901), ("k", "province", 0), ("l", "city", 0), ("m", "city", 2)]
    assert places.map_to_places(df.limit(0), ref).count() == 0
    assert {r.place_id for r in places.map_to_places(df, ref.limit(0)).collect()} == {0}


NAMED = "key string, name string, city string, province string, lat double, lng double, postal string, website string"


def named(spark, data):
    return spark.createDataFrame([(k, n, c, None, None, None, None, w, 0) for k, n, c, w in data], NAMED + ", side int")


def test_locate(spark, ref):
    df = spark.createDataFrame([("a", "Thaso", None, None, None, "K0A 1A1", None), ("b", None, None, None, None, "k0a9z9", None), ("c", "nowhere", None, 50.91, -85.79, None, "x.ca"), ("d", None, None, None, None, None, "http://www.x.ca/a"), ("e", None, None, None, None, None, None)], "key string, city string, province string, lat double, lng double, postal string, website string")
    assert {r.key: r.place_id for r in locate.locate(df, ref).collect()} == {"a": 1, "b": 1, "c": 4, "d": 4, "e": None}


def test_variants(spark, ref, rows):
    targets = named(spark, [("1", "Masjid Nuur Milond Sairnsetil", "Thaso", None), ("2", "Milond Sairnsetil School", "Thaso", None), ("3", "M. Sairnsetil Mosque", "THASO", None), ("4", "Masjid Milond Sairnsetil", "Port Muvevur", None), ("5", "Mosque", "Thaso", None), ("6", None, "Thaso", None), ("7", "Gelix Brovan", None, None), ("7", "Gelix Brovan", None, None), (None, "Gelix Brovan", None, None)])
    candidates = named(spark, [("a", "Sairnsetil Milond Mosque", "Thaso", None), ("b", "Masjid Milnod Sairnsetil of Thaso", "Thsao", None), ("c", "Milond Sairnsetil Academy", "Thaso", None), ("d", "Masjid", "Thaso", None), ("e", "Brovan Gelix Foundation", "Thaso", None), ("f", "", "Thaso", None), ("g", "x" * 9000, "Thaso", None)])
    got = rows(variants.link_variants(targets, candidates, ref))
    assert got == [("1", "a"), ("1", "b"), ("2", "c"), ("3", "a"), ("3", "b"), ("7", "e")]
    assert variants.link_variants(targets.limit(0), candidates, ref).count() == 0


def test_matching(spark, ref):
    cols = "key string, name string, city string, province string, lat double, lng double, postal string, phone string, website string, confidence double"
    row = lambda k, n, c, w: (k, n, c, None, None, None, None, None, w, 0.0)
    left = [row("a", "Milnod Sairnsetil Mosque", "Thaso", None), row("b", None, None, "http://own.ca/contact"), row("c", "Other Words Mosque", "Thaso", "own.ca"), row("d", "Masjid", "Thaso", None), row("e", "Sairnsetil Milond School", "Thaso", None), row("a", "Milnod Sairnsetil Mosque", "Thaso", None), row(None, "Milond Sairnsetil Mosque", "Thaso", None)]
    right = [row("X", "Masjid Sairnsetil Milond", "Thaso", None), row("Y", "Gelix Brovan Fdn", "Muvevur (QC)", "https://www.own.ca/"), row("Z", "", "", "")]
    l, r = spark.createDataFrame(left, cols), spark.createDataFrame(right, cols)
    got = {x.left_key: (x.right_key, x.confidence) for x in matching.match_entities(l, r, ref).collect()}
    assert {k: v[0] for k, v in got.items()} == {"a": "X", "b": "Y"} and all(0 < v[1] <= 1 for v in got.values())
    assert matching.match_entities(l.limit(0), r, ref).count() == 0 and matching.match_entities(l, r.limit(0), ref).count() == 0


def test_sorted_neighbours_cross_partition_borders(spark):
    """Every right profile of a sort key's neighbourhood is met, wherever the partitions end."""
    random.seed(6)
    words = sorted({"".join(random.choices("abcdefgh", k=6)) for _ in range(160)})
    data = [(i, i % 2, 1, "mosque", "", f"{w} tail", "") for i, w in enumerate(words)]
    df = spark.createDataFrame(data, "node long, side int, place_id int, purpose string, given string, own string, web string")
    exact = df.unionByName(spark.createDataFrame([(1000 + i, 1 - s, p, u, g, o, w) for i, s, p, u, g, o, w in data], df.schema))
    got = {(r.left, r.right) for r in matching.sorted_neighbours(exact, window=2).collect()}
    assert {(i, 1000 + i) if s == 0 else (1000 + i, i) for i, s, *_ in data} <= got


def test_addresses(spark, ref, rows):
    cols = "key string, address string, city string, province string, lat double, lng double, postal string, website string, number int"
    data = [
        ("a", "12 Divoulind Crescent East", "Thaso", "M7P 3Y7"),
        ("b", "Suite 4 - 12, Diovulind Cresc. E", "THASO", None),
        ("c", "12 Divoulind Terrace East", "Thaso", "M7P 1A1"),
        ("d", "12 Divoulind East", "Thaso", "m7p1a1"),
        ("e", "14 Divoulind Crescent East", "Thaso", None),
        ("f", "12 Divoulind Crescent East", "Port Muvevur", None),
        ("g", "PO Box 12", "Thaso", None),
        ("h", None, "Thaso", None),
        ("i", " ", "Thaso", None),
        (None, "12 Divoulind Crescent East", "Thaso", None),
        ("j", "12 Divoulind Crescent West", "Thaso", None),
        ("a", "12 Divoulind Crescent East", "Thaso", "M7P 3Y7"),
        ("k", "12 Divoulind Cres E", "Thaso", None),
        ("l", "12 Divoulind Crescent E", "Thaso", None),
    ]
    df = spark.createDataFrame([(k, a, c, None, None, None, p, None, 0) for k, a, c, p in data], cols)
    grouped = addresses.address_groups(df, ref)
    want = sorted([(x, y) for x in "abkl" for y in "abkl" if x < y] + [("c", "d")])
    for hot in (5_000, 2):
        assert rows(addresses.pairs_of_groups(grouped, "key", "address_group", hot=hot)) == want
    assert addresses.address_groups(df.limit(0), ref).count() == 0


# --- surviving values --------------------------------------------------------------------------------


def clean(spark, f, *values):
    return [r[0] for r in spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, v string").orderBy("i").select(f(F.col("v"))).collect()]


def test_clean_values(spark):
    assert clean(spark, golden.clean_email, " <Info@X.test>, ", "mailto:a.b@x.org.example", "info@", "a@@b.ca", "x at y", "none@none.test", "email@domain.example", "a@mailbox", None, "") == ["info@x.test", "a.b@x.org.example"] + [None] * 8
    assert clean(spark, golden.clean_phone, "T: 416-555-0397", "+1 (647) 555-0397 ext. 12", "tel:+1-902-555-6154", "555-555-5555", "123-456-7890", "416-555-", "416-555-xxxx", None) == ["4165550397", "6475550397", "9025556154"] + [None] * 5
    assert clean(spark, golden.clean_postal, "m7p-3y7", " M7P  3Y7", "M7?3Y7", "M7P3", "00000", None) == ["M7P3Y7", "M7P3Y7", None, None, None, None]
    account = lambda c: golden.clean_account(c, "facebook")
    assert clean(spark, account, "@A.b", "http://m.facebook.example/a.b?ref=page", "https://www.FACEBOOK.EXAMPLE/A.b/", "a.b", "share", "https://facebook.example/", "#", None) == ["a.b"] * 4 + [None] * 4


ORG = "id string, merged_into string, name string, slug string, province string, email string, phone string, postal_code string, social map<string,string>, created_at timestamp, grp string"
CAND = "id string, resolved_org_id string, source_id string, email string, phone string, postal_code string, social map<string,string>, created_at timestamp"


def at(day):
    import datetime

    return None if day is None else datetime.datetime(2025, 1, 1) + datetime.timedelta(days=day)


def org(i, into=None, day=0, email=None, phone=None, postal=None, social=None, name="Gelix Brovan"):
    return (i, into, name, f"gelix-brovan-thas0-{i}", "ON", email, phone, postal, social or {}, at(day), "x")


def cand(i, to, day=0, email=None, phone=None, postal=None, social=None, source="web"):
    return (i, to, source, email, phone, postal, social or {}, at(day))


def survivors(spark, orgs, cands):
    got = golden.surviving_records(spark.createDataFrame(orgs, ORG), spark.createDataFrame(cands, CAND))
    return {(r.org_id, r.field): r.value for r in got.collect()}


def test_roots(spark, rows):
    df = spark.createDataFrame([("a", None), ("b", "a"), ("c", "b"), ("d", "c"), ("e", "d"), ("f", "e"), ("x", "y"), ("y", "x"), ("z", "missing"), (None, "a")], "id string, merged_into string")
    assert rows(golden.group_roots(df)) == [(k, "a") for k in "abcdef"]


def test_survivors(spark):
    orgs = [org("a", email="gelix@old.test", phone="416-555-0001"), org("b", into="a", day=50, email="gelix@new.test"), org("alone", email="gelix@x.test"), org("u", into="v"), org("v", into="u")]
    cands = [
        cand("1", "b", 90, email="Gelix@NEW.test", phone="(416) 555-0002", social={"facebook": "@GelixBrovan", "other": "z"}),
        cand("2", "a", 95, phone="416.555.0002", source="cra", postal="k0a 1c4"),
        cand("3", "a", 99, email="someone@else.test", source="search", postal="K0A"),
        cand("4", "missing", 99, email="gelix@never.test"),
        cand("5", None, 99, email="gelix@never.test"),
    ]
    assert survivors(spark, orgs, cands) == {("a", "email"): "gelix@new.test", ("a", "phone"): "4165550002", ("a", "postal_code"): "K0A1C4", ("a", "facebook"): "gelixbrovan"}
    assert survivors(spark, [orgs[0]], []) == {} and survivors(spark, [], []) == {}


def test_survivors_without_dates_and_ties(spark):
    orgs = [org("a", day=None, email="gelix@one.test")]
    assert survivors(spark, orgs, [cand("1", "a", None, email="gelix@two.test")])[("a", "email")] in ("gelix@one.test", "gelix@two.test")
    same = [cand(str(i), "a", 5, email=e) for i, e in enumerate(["gelix@c.test", "gelix@b.test"])]
    assert survivors(spark, [org("a")], same) == survivors(spark, [org("a")], same[::-1])


# --- mixtures ------------------------------------------------------------------------------------------


def test_mixture(spark):
    random.seed(8)
    docs = [(i, random.choice(["big"] * 8 + ["mid", "small"]), random.randint(1, 900)) for i in range(4000)] + [(5000, "big", 0), (5001, "big", None), (5002, None, 7), (5003, "other", 7), (5004, "small", 10)]
    targets = spark.createDataFrame([("big", 0.5, 1), ("mid", 0.3, 2), ("small", 0.2, 4), ("absent", 0.1, 3)], "source string, weight double, max_repeats int")
    df = spark.createDataFrame([(*d, "clash") for d in docs], "doc_id long, source string, size long, copies string")
    mixture = mixing.mix(df, targets)
    got = mixture.collect()
    assert len(got) == len(docs) and {r.doc_id: r.copies for r in got if r.doc_id >= 5000 and r.doc_id != 5004} == {5000: 0, 5001: 0, 5002: 0, 5003: 0}
    most = {"big": 1, "mid": 2, "small": 4}
    assert all(0 <= r.copies <= most.get(r.source, 0) for r in got)
    for s in most:  # no document is copied two times more often than another of its source
        n = [r.copies for r in got if r.source == s and r.size]
        assert max(n) - min(n) <= 1
    shares = {r.source: r for r in mixing.mixture_shares(mixture, targets).collect()}
    for s, w in (("big", 0.5), ("mid", 0.3), ("small", 0.2)):
        assert shares[s].actual == pytest.approx(w, abs=0.01)
    assert shares["absent"].actual == 0.0 and shares["other"].target == 0.0
    assert sorted(tuple(r) for r in mixing.mix(df.limit(0), targets).collect()) == []
    assert {r.copies for r in mixing.mix(df, targets.limit(0)).collect()} == {0}


def test_a_mixture_keeps_rows_of_null_and_repeated_ids(spark):
    df = spark.createDataFrame([(1, "a", 5), (1, "a", 7), (None, "a", 3), (None, "b", 3), (2, None, 4)], "doc_id long, source string, size long")
    targets = spark.createDataFrame([("a", 0.5, 2), ("b", 0.5, 2)], "source string, weight double, max_repeats int")
    got = mixing.mix(df, targets).collect()
    assert sorted((r.doc_id or 0, r.source or "", r.size) for r in got) == [(0, "a", 3), (0, "b", 3), (1, "a", 5), (1, "a", 7), (2, "", 4)]


# --- stuffed pages -------------------------------------------------------------------------------------

HONEST = "We ask parents to keep the entrance clear, since the lift is out of order. The board repaired the boiler because of the storm, and the final cost was paid by the families. "


def test_stuffed(spark, rows):
    docs = [
        (1, "halal pizza, best halal pizza, halal pizza deal, halal pizza near me, cheap halal pizza, halal pizza sale, halal pizza"),
        (2, "https://a.test/x/y https://b.test/tag/z http://c.test/p/q https://d.test/go?id=1 www.e.test/out/k"),
        (3, "[prayer mat](https://a.test/x) | [azan clock sale](https://b.test/y) | [hijab pins](https://c.test/z) | [kufi cap](https://d.test/z)"),
        (4, " ".join(f"#tag{i}" for i in range(20))),
        (5, "Welcome to our page, we are here for you.\n" + "\n".join(f"umrah-package-{a}\nkufi-cap-{a}" for a in ("cheap", "sale", "best", "price", "deal", "shop", "online"))),
        (6, HONEST * 3),
        (7, HONEST + "#prayer #mosque"),
        (8, "Prayer times\n" + "\n".join(f"{d} Fajr 5:{d + 10} Dhuhr 1:{d + 20} Asr 4:{d + 15}" for d in range(1, 29))),
        (9, "\n".join(f"Belix Centre {i}, {i} Gashofon Road, Thaso, ON - 416-555-0{i}" for i in range(100, 120))),
        (10, "Useful pages\n" + "\n".join(f"https://s{i}.test/help - We are looking for people who can cook for the family dinner this month." for i in range(4))),
        (11, None),
        (12, ""),
        (13, "  \n "),
        (14, "Mosque"),
        (1, "halal pizza, best halal pizza, halal pizza deal, halal pizza near me, cheap halal pizza, halal pizza sale, halal pizza"),
        (None, "#a1 #a2 #a3 #a4"),
    ] + [(100 + i, HONEST) for i in range(6)]
    df = spark.createDataFrame([(*d, 0.5) for d in docs], "doc_id long, text string, n_words double")
    assert rows(stuffing.stuffed(df, "doc_id", "text")) == [(1,), (2,), (3,), (4,), (5,)]
    assert stuffing.stuffed(df.limit(0), "doc_id", "text").count() == 0


def test_a_very_long_text(spark):
    df = spark.createDataFrame([(1, "azan clock sale, " * 40_000), (2, HONEST * 3_000)], "doc_id long, text string")
    assert [r.doc_id for r in stuffing.stuffed(df, "doc_id", "text").collect()] == [1]


FOREIGN = [
    "Die Gemeinde lädt am Samstag alle Nachbarn zum Frühstück ein. Wer helfen möchte, kann sich bis Freitag im Büro melden, denn wir brauchen noch Stühle und Tische. Kinder dürfen kostenlos mitessen, und der Erlös geht an das neue Dach.",
    "Unser Vorstand traf sich gestern Abend und sprach lange über den Umbau der Küche, der im Sommer beginnen soll. Manche Mitglieder fanden die Kosten zu hoch, doch am Ende stimmten fast alle dafür, weil der alte Herd nicht mehr sicher war.",
    "De buurt heeft vorige week samen de tuin opgeknapt en daarna soep gegeten. Iedereen die wilde kon een plant meenemen, en de kinderen maakten een bord voor bij de poort waarop staat wie er geholpen heeft.",
    "Mahalle sakinleri geçen hafta bahçeyi birlikte temizledi ve ardından çorba içti. Çocuklar kapıya bir tabela astı, yaşlılar ise eski günleri anlattı; akşam olunca herkes evine mutlu döndü.",
    "Warga kampung membersihkan kebun bersama minggu lalu lalu makan siang di halaman. Anak-anak membuat papan nama untuk gerbang, sedangkan para orang tua bercerita tentang masa kecil mereka sampai sore hari.",
    "Los vecinos limpiaron el jardín la semana pasada y luego comieron sopa todos juntos. Los niños hicieron un cartel para la puerta, mientras que los mayores contaban historias de cuando el barrio era todavía un campo.",
]


def test_honest_texts_of_other_languages_are_not_stuffed(spark):
    """Nothing tells their function words, so only repetition, separators and links count."""
    heaps = [(500, "gebetsteppich kaufen, gebetsteppich billig, gebetsteppich angebot, datteln kaufen, datteln billig, datteln angebot, honig kaufen, honig billig, honig angebot, gebetsteppich rabatt, datteln rabatt")]
    for extra in ([], [(100 + i, HONEST) for i in range(40)]):
        df = spark.createDataFrame([*enumerate(FOREIGN), *heaps, *extra], "doc_id long, text string")
        assert [r.doc_id for r in stuffing.stuffed(df, "doc_id", "text").collect()] == [500]


def test_repeated_sentences_and_refrains(spark):
    verses = [f"In the {a} of the year we walk to the {b}, and there we sit until the {c} has gone." for a, b, c in (("spring", "river", "rain"), ("summer", "meadow", "heat"), ("autumn", "orchard", "fog"), ("winter", "kitchen", "snow"))]
    refrain = "Oh come with us and stay a while"
    docs = [(1, "Where to buy the best halal food in Thaso\n" * 40), (2, "\n".join(x for v in verses for x in (v, refrain)))] + [(100 + i, HONEST) for i in range(40)]
    df = spark.createDataFrame(docs, "doc_id long, text string")
    assert [r.doc_id for r in stuffing.stuffed(df, "doc_id", "text").collect()] == [1]


def test_features_of_a_page():
    of = lambda t: dict(zip(stuffing.FEATURES, stuffing.features(t)[1]))
    page = of("buy red hats today | buy red hats now\nbuy red hats today | buy red hats now")
    assert page["n_words"] == 16 and page["line_share"] == 0.5 and page["gram_share"] == 1.0 and page["separators"] == 4 / 16
    assert stuffing.features("der Hund schläft heute lange")[0] == "" and stuffing.features("وقد كان المطر في كل مكان")[0] == "ar"
    assert stuffing.features(" \n")[1] == [0.0] * len(stuffing.FEATURES)


# --- nothing is left out before it is compared ---------------------------------------------------------


def test_variants_meet_however_many_edits_their_joined_names_have(spark, ref, rows):
    """An initial or a short form beside a mistyped word is more than seven edits away."""
    targets = named(spark, [("1", "L. Vipind Mosque", "Thaso", None), ("2", "Masjid W. Shizumbis", "Thaso", None)])
    candidates = named(spark, [("a", "Masjid Lairsisa Vipnid", "Thaso", None), ("b", "Masjed Woukouvanai Shzumbis", "Thaso", None)])
    assert rows(variants.link_variants(targets, candidates, ref)) == [("1", "a"), ("2", "b")]


def test_no_pair_that_likeness_accepts_is_left_out(spark):
    random.seed(11)

    def typed(w):
        kind, i = random.randrange(7), random.randrange(len(w))
        return [w, w[:1], w[:3], w[:i] + w[i + 1 :] or w, w[:i] + random.choice("aeimn") + w[i:], w[:i] + w[i + 1 : i + 2] + w[i : i + 1] + w[i + 2 :], w[:i] + random.choice("sz") + w[i + 1 :]][kind]

    pairs = []
    for _ in range(6000):
        words = ["".join(random.choices("abdeimnosu", k=random.randrange(2, 13))) for _ in range(random.choice([1, 2, 2, 2, 3]))]
        a, b = [typed(typed(w)) for w in words], [typed(typed(w)) for w in words]
        if random.random() < 0.1:
            b = ["".join(b)]
        pairs.append((" ".join(sorted(a)), " ".join(sorted(b))))
    pairs += [("aaaaaaaaaaaa bee", "aaaaaaaaaaa bee"), ("q", "q")]
    side = lambda s, k: next(variants._with_codes([pd.DataFrame({"own": [p[k] for p in pairs], "given": ""})])).drop(columns="codes").add_suffix(f"_{s}")
    df = spark.createDataFrame(pd.concat([side("a", 0), side("b", 1)], axis=1))
    kept = {(r.own_a, r.own_b) for r in df.filter(variants.may_agree()).collect()}
    like = {p for p in pairs if names.likeness(tuple(p[0].split()), "", tuple(p[1].split()), "") > 0}
    assert len(like) > 500 and like <= kept


def test_many_spellings_of_one_organisation_make_no_platform(spark, ref):
    random.seed(3)
    cols = "key string, name string, city string, province string, lat double, lng double, postal string, phone string, website string"
    row = lambda k, n, w: (k, n, "Thaso", None, None, None, None, None, w)

    def typed(w):
        i = random.randrange(1, len(w))
        return w[:i] + random.choice("aeioukst") + w[i + random.randrange(2) :]

    left = [row(f"own{i}", f"{typed('Milond')} {typed('Sairnsetil')} Mosque", "own.ca") for i in range(300)]
    left += [row(f"any{i}", "".join(random.choices("bdgklmnprst", k=6)) + " " + "".join(random.choices("aeioubdgklmnprst", k=7)), "any.ca") for i in range(300)]
    left += [row("on own", None, "http://own.ca/contact"), row("on any", None, "any.ca")]
    right = [row("X", "Masjid Sairnsetil Milond", "own.ca"), row("Y", "Gelix Brovan Fdn", "any.ca")]
    got = {x.left_key: x.right_key for x in matching.match_entities(spark.createDataFrame(left, cols), spark.createDataFrame(right, cols), ref).collect()}
    assert got["on own"] == "X" and "on any" not in got


def test_values_of_many_groups_survive_where_there_is_no_other(spark):
    orgs = [org(f"o{i}", phone="416-555-0100", postal="K0A 1A1") for i in range(40)]
    cands = [cand(f"c{i}", f"o{i}", 60, phone="416-555-0100", postal="K0A 1A1") for i in range(39)] + [cand("c39", "o39", 60, phone="416-555-0177", postal="K0A 1A1")]
    got = survivors(spark, orgs, cands)
    assert all(got[(f"o{i}", "postal_code")] == "K0A1A1" for i in range(40)) and all(got[(f"o{i}", "phone")] == "4165550100" for i in range(39))
    assert got[("o39", "phone")] == "4165550177"


def test_precedence_orders_groups_without_dates(spark):
    """Area codes 416 are given up for 647 in dated groups, so 647 is the later one where nothing is dated."""
    orgs = [org(f"o{i}", day=0, phone=f"416-555-1{i:03}") for i in range(30)] + [org(f"u{i}", day=None, phone=p) for i, p in enumerate(["416-555-2000", "647-555-2001"])]
    cands = [cand(f"c{i}{k}", f"o{i}", 50 + k, phone=f"647-555-1{i:03}", source=s) for i in range(30) for k, s in enumerate(("web", "cra"))]
    cands += [cand("u0c", "u0", None, phone="647-555-3000"), cand("u1c", "u1", None, phone="416-555-3001"), cand("half", "o5", None, phone="416-555-9999")]
    got = survivors(spark, orgs, cands)
    assert got[("u0", "phone")] == "6475553000" and got[("u1", "phone")] == "6475552001"
    assert all(got[(f"o{i}", "phone")] == f"6475551{i:03}" for i in range(30))


def test_learnt_leans_are_opposite(spark):
    rows = [(f"g{i}", "phone", v, float(t), float(t), "web", k, "own", 1, 0.0) for i in range(9) for t, (v, k) in enumerate([("a", "416"), ("b", "647")] if i else [("b", "647"), ("a", "416")])]
    df = spark.createDataFrame(rows, "grp string, field string, value string, first double, last double, source string, kind string, belongs string, groups long, common double")
    lean = {(r.kind, r.later_kind): r.lean for r in golden.learnt(df)[1].collect()}
    assert lean[("416", "647")] == pytest.approx(9 / 11 - 0.5) and lean[("647", "416")] == pytest.approx(2 / 11 - 0.5)


def test_one_to_one_assignment_is_the_greatest(spark):
    from itertools import permutations

    random.seed(8)
    for n in (3, 5):
        pairs = [(f"l{i}", f"r{j}", round(random.random(), 3)) for i in range(n) for j in range(n) if random.random() < 0.8]
        worth = {(a, b): c for a, b, c in pairs}
        best = max(sum(worth.get((f"l{i}", f"r{j}"), 0) for i, j in enumerate(p)) for p in permutations(range(n)))
        got = matching.one_to_one(spark.createDataFrame([*pairs, pairs[0], (None, "r0", 1.0), ("l0", "r1", 0.0)], "left_key string, right_key string, confidence double"), epsilon=1e-5).collect()
        assert len({r.left_key for r in got}) == len({r.right_key for r in got}) == len(got)
        assert sum(r.confidence for r in got) == pytest.approx(best, abs=n * 1e-5 + 1e-9)
    crowd = [(f"l{i}", "r", 0.9 - i / 100) for i in range(30)]
    assert [tuple(r) for r in matching.one_to_one(spark.createDataFrame(crowd, "left_key string, right_key string, confidence double")).collect()] == [("l0", "r", 0.9)]
    assert matching.one_to_one(spark.createDataFrame([], "left_key string, right_key string, confidence double")).count() == 0


def test_given_names_by_rule():
    pairs = [("Al Rahman Centre", "Ar-Rahmaan Center"), ("William Booth School", "Bill Booth School"), ("Masjid Abdul-Rahman Zenta", "Abdur Rahmaan Zenta Mosque"), ("Masjid Fatimah", "Mosque Fatma"), ("Masjid As-Salaam", "Assalam Mosque"), ("Masjid Al Noor Zenta", "Nur Zenta Masjid")]
    like = {}
    for a, b in pairs:
        x, y = names.parse_name(a), names.parse_name(b)
        like[a] = names.likeness(tuple(sorted(x[2])), x[1], tuple(sorted(y[2])), y[1])
    assert not {a for a, v in like.items() if v < 0.9}
    x, y = names.parse_name("Masjid Bilal Zenta"), names.parse_name("Masjid Hamza Zenta")
    assert names.likeness(x[2], x[1], y[2], y[1]) == 0.0
    assert names.without_articles(["an", "nur"]) == ["nur"] and names.without_articles(["an", "apple"]) == ["an", "apple"] and names.without_articles(["at", "home"]) == ["at", "home"] and names.without_articles(["al"]) == ["al"]


def test_long_street_names_and_chains(spark, rows):
    long = "abcdefghij" * 20
    spelled = [(1, long, 9), (1, long[:-1] + "x", 2), (1, "gashofon", 90), (1, "gashofom", 30), (1, "gashofmm", 10), (1, "gashmmmm", 3), (1, "highway10", 50), (1, "highway11", 4), (2, "gashofom", 3), (1, "main", 40), (1, "mair", 30)]
    got = {(r.place_id, r.name): r.street for r in addresses.street_spellings(spark.createDataFrame(spelled, "place_id int, name string, n long")).collect()}
    assert len(got) == len(spelled)
    assert got[(1, long[:-1] + "x")] == long and got[(1, "gashofmm")] == "gashofon" and got[(2, "gashofom")] == "gashofom"
    assert got[(1, "highway11")] == "highway11" and got[(1, "mair")] == "mair"
    twenty = [(p, n, c * 20) for p, n, c in spelled]
    again = {(r.place_id, r.name): r.street for r in addresses.street_spellings(spark.createDataFrame(twenty, "place_id int, name string, n long")).collect()}
    assert again == got


@pytest.mark.parametrize(
    "text, parts",
    [
        ("123-125 Main St", ("123", "main", "street", "")),
        ("123 1/2 King St W", ("123", "king", "street", "w")),
        ("12½ King St W", ("12", "king", "street", "w")),
        ("5-123 Main St", ("123", "main", "street", "")),
        ("12 - 14 Rue Principale", ("12", "principale", "street", "")),
    ],
)
def test_ranges_units_and_fractions(text, parts):
    from orgloom.llm.streets import parse_address

    assert parse_address(text) == parts


def test_every_piece_of_a_city_is_looked_up(spark, ref):
    records = spark.createDataFrame([("a", "city", "Old Town, Thaso, ON", None, None, None), ("b", "city", "12 Main St; Thaso", None, None, None), ("c", "city", "Thaso / Oldname", None, None, None), ("d", "city", "Nowhere, Elsewhere", None, None, None)], "record_id string, field string, text string, province string, lat double, lng double")
    assert {r.record_id: r.place_id for r in places.map_to_places(records, ref).collect()} == {"a": 1, "b": 1, "c": 1, "d": 0}


def test_a_hot_block_of_spellings_loses_no_pair(spark, ref, rows, monkeypatch):
    """Blocks dealt to several tasks give the pairs they give as one."""
    random.seed(6)
    typed = lambda: "".join(c if random.random() > 0.06 else random.choice("aeiou") for c in "Milond Sairnsetil")
    targets = named(spark, [(str(i), typed() + " Mosque", "Thaso", None) for i in range(12)])
    candidates = named(spark, [(f"c{i}", typed() + " Masjid", "Thaso", None) for i in range(150)])
    whole = rows(variants.link_variants(targets, candidates, ref))
    monkeypatch.setattr(variants, "HOT_BLOCK", 20)
    assert rows(variants.link_variants(targets, candidates, ref)) == whole and len(whole) > 500
