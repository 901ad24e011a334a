"""Names of organisations as people type them: parts, phonetic codes and comparison."""

from __future__ import annotations

import re
from functools import lru_cache

from orgloom.llm.text import edits, fold, jaro_winkler

#: Words that tell what an organisation is.
PURPOSE_WORDS = {
    "youth": ["youth", "jeunes", "jeunesse"],
    "school": ["academy", "acad", "school", "ecole", "madrasa", "madrassa", "madrasah"],
    "foundation": ["foundation", "fdn", "fndn", "fondation"],
    "musalla": ["musalla", "musallah", "mussala", "mussalla", "musala", "prayer", "priere"],
    "mosque": ["masjid", "masjed", "mesjid", "masjeed", "msjd", "mosque", "mosquee", "moschee"],
    "association": ["association", "assoc", "assn", "asso"],
    "society": ["society", "soc", "societe"],
    "centre": ["centre", "center", "cntr", "ctr", "centr", "cen"],
}
#: Words that say nothing of which organisation it is.
EMPTY_WORDS = ["islamic", "isl", "islamique", "muslim", "muslims", "musulman", "musulmane", "club", "hall", "room", "salle", "jamia", "jami", "jame", "the", "of", "de", "du", "des", "la", "le", "les", "et", "and", "for", "inc", "incorporated", "ltd", "limited", "org", "organization", "organisation", "registered", "reg", "corp", "untitled", "unknown", "community"]
#: Common given names with the short forms and translations that no rule of ``romanised`` leads to.
GIVEN_NAMES = {
    "abbas": [], "adam": [], "ahmad": ["ahmet"], "aisha": ["ayesha", "aysha", "aicha"], "akbar": [], "ali": ["aly"], "amina": [], "anas": [], "asma": [], "ayub": ["job"],
    "aziz": [], "badr": [], "bakr": [], "bilal": ["belal"], "daud": ["dawud", "dawood", "david", "dave"], "falah": [], "faruq": [], "fatima": ["fatma", "fatimah"], "furqan": [], "habib": [],
    "hafsa": [], "hamid": [], "hamza": ["hamsa"], "harun": ["aaron"], "hasan": [], "hidaya": ["hidayat"], "huda": [], "husayn": ["hussein", "hussain", "husain", "huseyin"], "ibrahim": ["ibrahem", "brahim", "abraham", "abe"],
    "idris": [], "ihsan": [], "ikhlas": [], "iman": [], "imran": [], "isa": ["eesa", "issa"], "ishaq": ["isaac", "isak"], "ismail": ["ismael"], "jafar": [], "jamal": [],
    "karim": [], "khadija": ["hadija", "kadija"], "khalid": [], "madina": [], "mahdi": [], "mahmud": [], "malik": [], "maryam": ["miriam", "mary", "marie"], "muhammad": ["mohd", "muhd", "md", "mhd", "mehmet", "mamadou"], "musa": ["moses"],
    "mustafa": [], "najm": [], "nuh": ["noah"], "nur": [], "qadir": [], "qasim": [], "quba": [], "rahim": [], "rahma": ["rahmat"], "rahman": [],
    "rashid": [], "ridwan": [], "sabr": [], "sadiq": [], "safa": [], "salam": [], "salih": [], "salman": [], "sulayman": ["suleiman", "solomon"], "tariq": [],
    "taqwa": [], "tawhid": ["tauheed"], "taybah": ["tayba"], "umar": [], "uthman": ["osman", "usman"], "yahya": [], "yaqub": ["jacob", "jake", "jakob"], "yasin": [], "yunus": ["jonah"], "yusuf": ["yusef", "yousef", "youssef", "yousif", "joseph", "joe"],
    "zahra": [], "zakariya": ["zachary"], "zayd": ["zaid"], "zaynab": ["zainab"], "zubayr": ["zubair"],
    "anthony": ["tony"], "benjamin": ["ben"], "catherine": ["kate", "cathy", "katherine", "kathryn"], "charles": ["charlie", "chuck"], "christopher": ["chris"], "daniel": ["dan", "danny"], "edward": ["ed", "eddie", "ted"], "elizabeth": ["liz", "beth", "betty"], "george": [], "henry": ["harry"],
    "james": ["jim", "jimmy"], "john": ["jack", "johnny"], "margaret": ["maggie", "peggy", "meg"], "matthew": ["matt"], "michael": ["mike", "mick"], "nicholas": ["nick"], "patrick": ["pat", "paddy"], "peter": ["pete"], "richard": ["rick", "dick"], "robert": ["bob", "bobby", "rob"],
    "samuel": ["sam"], "stephen": ["steven", "steve"], "susan": ["sue", "susie"], "theresa": ["terry", "teresa"], "thomas": ["tom", "tommy"], "timothy": ["tim"], "william": ["bill", "billy", "willy"],
}
#: The Arabic article as it is written before a word, and before one that begins with the same sound.
ARTICLES, JOINED_ARTICLES = ["al", "el", "ul"], ["ad", "an", "ar", "as", "ash", "at", "az", "ud", "un", "ur", "us", "ut", "uz"]
#: Fixed values: "servant of", which is one name with the word behind it.
SERVANT = ["abd", "abdu", "abdul", "abdal", "abdel", "abdoul", "abdur", "abdar", "abdus", "abdun"]
_camel, _letters = re.compile(r"(?<=[a-zà-öø-ÿ])(?=[A-Z])"), re.compile(r"[a-z]+")
_purpose = {w: p for p, words in PURPOSE_WORDS.items() for w in words}
_empty = set(EMPTY_WORDS)
_long = [w for w in [*_purpose, *EMPTY_WORDS] if len(w) > 4]
_by_start: dict[str, list[int]] = {}  # places in _long of words with a first letter, or with a second and third one
for _i, _w in enumerate(_long):
    _by_start.setdefault(_w[0], []).append(_i)
    _by_start.setdefault(_w[1:3], []).append(_i)
#: Initials of two common kinds of names.
_initials = {"ic": "centre", "ma": "association", "is": "society", "mc": "centre", "ia": "association"}


@lru_cache(maxsize=30_000)
def _generic(word: str) -> str | None:
    """A purpose, '' for an empty word, None for a word of its own; small typos in long words are forgiven."""
    if word in _purpose:
        return _purpose[word]
    if word in _empty:
        return ""
    if len(word) > 4:
        for i in sorted({*_by_start.get(word[0], ()), *_by_start.get(word[1:3], ())}):
            w, most = _long[i], 1 if len(_long[i]) < 8 else 2
            if abs(len(w) - len(word)) < 2 and edits(word, w, most) <= most:
                return _purpose.get(w, "")
    return None


@lru_cache(maxsize=30_000)
def romanised(word: str) -> str:
    """One spelling for the ways in which a name of another script is written in Latin letters.

    Doubled letters once, long vowels short, e and a alike, o and u alike, y
    and i alike, q as k, a last h or e left out.
    """
    s = re.sub(r"^e+(?=[^aeiou])", "i", word)
    for a, b in (("ee", "i"), ("oo", "u"), ("ou", "u"), ("qu", "kw"), ("q", "k"), ("dh", "z"), ("iy", "i"), ("y", "i"), ("o", "u"), ("e", "a"), ("v", "w")):
        s = s.replace(a, b)
    s = re.sub(r"(.)\1+", r"\1", s)
    return re.sub(r"(?<=a)h$", "", s[:-1] if len(word) > 5 and word.endswith("e") else s)


_given = {romanised(v): k for k, vs in GIVEN_NAMES.items() for v in [k, *vs]}
_short = {v for vs in GIVEN_NAMES.values() for v in vs if len(v) < 4} | {k for k in GIVEN_NAMES if len(k) < 4}
_joined_servant, _joined_article = re.compile(r"abd[aeou]{1,2}[lrsn](?=.{3})"), re.compile(r"[ae]l.{3}|a([dnrstz])\1..")
_article, _joined, _servant = set(ARTICLES), set(JOINED_ARTICLES), set(SERVANT)


@lru_cache(maxsize=30_000)
def given_name(word: str) -> str:
    """The common form of a given name, also with the article or "servant of" joined to it; '' for other words. Two letters must be spelled as listed."""
    if len(word) < 3 and word not in _short:
        return ""
    if found := _given.get(romanised(word)):
        return found
    if word[0] not in "ae":
        return ""
    if m := _joined_servant.match(word):
        rest = given_name(word[m.end() :])
        return f"abd{rest}" if rest else ""
    return _given.get(romanised(word[2:]), "") if _joined_article.match(word) else ""


def without_articles(words: list[str]) -> list[str]:
    """Words without the Arabic article before another word; 'servant of' and the word behind it are one."""
    out: list[str] = []
    i = 0
    while i < len(words):
        w, after = words[i], words[i + 1] if i + 1 < len(words) else ""
        if after and (w in _article or (w in _joined and len(after) > 2 and after.startswith(w[1:]))):
            i += 1
        elif w in _servant and after:
            rest = without_articles(words[i + 1 :])
            return [*out, "abd" + romanised(rest[0]), *rest[1:]]
        else:
            out.append(w)
            i += 1
    return out


def parse_name(name: str | None, city_keys: tuple[str, ...] = ()) -> tuple[str, str, tuple[str, ...]]:
    """(purpose, given name, words of its own in order); a place named at the end is left out.

    The purpose is '' where none is told; a name of general words only has no
    words of its own; a given name that stands alone is the name's own word.
    """
    spaced = _camel.sub(" ", name or "")
    words = _letters.findall(fold(spaced).replace("'", ""))
    joined: list[str] = []
    for w in words:  # general words torn apart by a stray space
        if joined and len(w) > 1 and len(joined[-1]) > 1 and joined[-1] not in _purpose and w not in _purpose and (joined[-1] + w in _purpose or joined[-1] + w in _empty):
            joined[-1] += w
        else:
            joined.append(w)
    words = without_articles(joined)
    for key in city_keys:
        for n in (1, 2, 3):
            if key and len(words) > n + 1:
                tail = "".join(words[-n:])
                if tail == key or (len(key) > 5 and edits(tail, key, 1) <= 1):
                    words = words[:-n]
                    break
    purposes, given, own, letters = [], "", [], ""
    for w in words:
        kind = _generic(w)
        if kind is None:
            if (g := given_name(w)) and not given:
                given = g
            elif len(w) == 1 and not own and len(words) > 2:
                letters += w
                own.append(w)
            else:
                own.append(w)
        elif kind:
            purposes.append(kind)
    purpose = next((p for p in PURPOSE_WORDS if p in purposes), "")
    if not purpose:
        for i in range(len(own) - 1):
            pair = own[i] + own[i + 1]
            if len(own[i]) == len(own[i + 1]) == 1 and pair in _initials and len(own) > 2:
                purpose, own = _initials[pair], own[:i] + own[i + 2 :]
                break
        else:
            if len(own) > 2 and own[0] in _initials:
                purpose, own = _initials[own[0]], own[1:]
    if len(own) == 3 and not given and own[0] in ("m", "md"):
        given, own = "muhammad", own[1:]
    if given and not own:  # called after nothing but a given name
        return purpose, "", (given,)
    return purpose, given, tuple(own)


_digraphs = [("kh", "k"), ("sh", "x"), ("ch", "x"), ("th", "t"), ("ph", "f"), ("gh", "g")]
_sounds, _silent, _doubled = str.maketrans("qczvj", "kksfg"), str.maketrans("", "", "aeiouywh"), re.compile(r"(.)\1+")


@lru_cache(maxsize=30_000)
def sound(word: str) -> str:
    """A phonetic code: consonants by their sound, doubled ones once, vowels only at the start (as 'a')."""
    s = word
    if "h" in s:
        for a, b in _digraphs:
            s = s.replace(a, b)
    s = s.replace("ck", "k").translate(_sounds)
    head = "a" if s[:1] in "aeiouy" else s[:1]
    return _doubled.sub(r"\1", head + s[1:].translate(_silent))


def block_codes(own: tuple[str, ...]) -> list[str]:
    """Codes of which two spellings of one name share at least one, made of the phonetic codes of the sorted words.

    Each pairs the whole code of one word with the first or last sound of the
    other, so a typo in either word, or an initial in place of it, leaves one
    intact.
    """
    words = sorted(own)
    if len(words) == 1:
        return [f"1{sound(words[0])}"]
    out = []
    codes = sorted({sound(w) for w in words})
    for i, a in enumerate(codes if len(codes) > 1 else codes * 2):
        for j, b in enumerate(codes if len(codes) > 1 else codes * 2):
            if i != j and len(a) > 1:
                out += [f"{a}|{b[0]}", f"{a}/{b[-1]}"] if len(b) > 1 else [f"{a}|{b[0]}"]
    out.append("2" + "".join(c[:2] for c in codes))
    out.append("1" + sound("".join(own)))
    return list(dict.fromkeys(out))


#: Bits of a word's letters; above them stands its first letter.
LETTER_BITS = 58


@lru_cache(maxsize=30_000)
def letters(word: str) -> int:
    """A word of a-z as bits: two for each letter, for its first and second time, six for further times, then the first letter.

    ``a & b`` below ``LETTER_BITS`` has at least as many ones as the words share
    letters, repeated ones counted; -1 for words with more repeats than fit.
    """
    bits = more = 0
    for c in word:
        one = 1 << 2 * (ord(c) - 97)
        if not bits & one:
            bits |= one
        elif not bits & one << 1:
            bits |= one << 1
        else:
            more += 1
    return -1 if more > 6 else bits | ((1 << more) - 1) << 52 | (ord(word[0]) - 96 if word else 0) << LETTER_BITS


@lru_cache(maxsize=30_000)
def word_likeness(a: str, b: str) -> float:
    if a == b:
        return 1.0
    short, long = (a, b) if len(a) <= len(b) else (b, a)
    n = len(short)
    if n == 1:
        return 0.86 if long[0] == short else 0.0
    if n > 2 and long.startswith(short):
        return 0.94
    x, y = letters(a), letters(b)
    both = (x & y & ((1 << LETTER_BITS) - 1)).bit_count() if x >= 0 and y >= 0 else n
    far = both < len(long) - 2  # more than two edits
    most = (both / n + both / len(long) + 1) / 3  # of Jaro; a common beginning takes off up to 0.4 of what is left to 1
    if far and most + (0.4 * (1 - most) if a[0] == b[0] else 0.0) < 0.8:
        return 0.0  # below any threshold in use
    jw = jaro_winkler(a, b)
    if jw >= 0.93 or n < 4 or far:
        return jw
    return max(jw, {1: 0.93, 2: 0.87 if n > 6 else 0.0}.get(edits(a, b, 2), 0.0))


def likeness(a: tuple[str, ...], given_a: str, b: tuple[str, ...], given_b: str) -> float:
    """0 to 1: how well two names' own words agree, in whichever order; 0 where given names differ."""
    if given_a and given_b and given_a != given_b:
        return 0.0
    if not a or not b:
        return 0.0
    if sorted(a) == sorted(b):
        return 1.0
    if len(a) == len(b) == 2:
        best = 0.0
        for x, y in ((b[0], b[1]), (b[1], b[0])):
            s = word_likeness(a[0], x)
            t = word_likeness(a[1], y) if s >= 0.8 else 0.0
            low, high = min(s, t), max(s, t)
            if (low >= 0.8 and high == 1.0) or (low >= 0.86 and high >= 0.9):
                best = max(best, (s + t) / 2)
        return best
    if len(a) == len(b) == 1:
        return like if (like := word_likeness(a[0], b[0])) >= 0.93 else 0.0
    if len(a) == len(b):
        left, total = list(b), []
        for w in a:
            v = max(left, key=lambda x: word_likeness(w, x))
            total.append(word_likeness(w, v))
            left.remove(v)
        return sum(total) / len(total) if min(total) >= 0.86 and sorted(total)[1] >= 0.93 else 0.0
    one, other = "".join(sorted(a)), "".join(sorted(b))
    plain = max(jaro_winkler("".join(a), "".join(b)), jaro_winkler("".join(a), "".join(reversed(b))), jaro_winkler(one, other))
    return plain if plain >= 0.96 and abs(len(one) - len(other)) <= 2 else 0.0
