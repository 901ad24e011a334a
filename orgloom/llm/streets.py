"""Parts of a typed street address."""

from __future__ import annotations

import re
from functools import lru_cache

from orgloom.llm.text import edits, fold

#: Kinds of streets, with their short forms in English and French.
STREET_KINDS = {
    "avenue": ["avenue", "ave", "av", "aven"],
    "boulevard": ["boulevard", "blvd", "boul", "bd", "bvd"],
    "court": ["court", "crt", "ct"],
    "crescent": ["crescent", "cresc", "cres", "cr", "croissant"],
    "drive": ["drive", "drv", "dr", "promenade", "prom"],
    "lane": ["lane", "ln", "ruelle"],
    "parkway": ["parkway", "pkwy", "pky"],
    "place": ["place", "pl"],
    "road": ["road", "rd", "chemin", "ch"],
    "street": ["street", "str", "st", "rue"],
    "terrace": ["terrace", "terr", "ter", "terrasse"],
    "trail": ["trail", "trl", "tr", "sentier"],
    "way": ["way", "wy", "voie"],
    "circle": ["circle", "cir", "cercle"],
    "highway": ["highway", "hwy", "autoroute"],
    "square": ["square", "sq", "carre"],
    "gate": ["gate"],
    "close": ["close"],
}
#: Directions.
DIRECTIONS = {"n": ["north", "n", "nord", "no"], "s": ["south", "s", "sud", "so"], "e": ["east", "e", "est"], "w": ["west", "w", "ouest", "o"]}
_kind = {w: k for k, ws in STREET_KINDS.items() for w in ws}
_direction = {w: d for d, ws in DIRECTIONS.items() for w in ws}
_long_kinds = [w for w in _kind if len(w) > 4]
#: What makes an address one without a street.
_NO_STREET = re.compile(r"\b(?:p\s?\.?\s?o\.?\s*box|post office box|boite postale|case postale|c\s?\.?p\.?\s*\d|c/o|general delivery|poste restante|r\.?\s?r\.?\s*#?\s*\d|rural route|by appointment|mailbox|stn [a-z]\b)")
#: Parts within a building.
_UNIT = re.compile(
    r"\b(?:suite|ste|unit|unite|apt|apartment|app|appartement|bureau|room|rm|local|office|porte|door|bay)\.?\s*#?\s*(?:\d+[a-z]?|[a-z])\b"
    r"|\b\d+(?:st|nd|rd|th|er|e|eme)?\s*(?:floor|fl|etage|flr)\b|\b(?:ground|main|first|second|third|lower|upper|top)\s+(?:floor|level|unit)\b"
    r"|\b(?:side|back|front|rear|main)\s+(?:door|entrance|building|unit)\b|\((?:[^)]*)\)|\b(?:basement|rear|upstairs|downstairs|sous-sol)\b"
)
_TWO_NUMBERS = re.compile(r"\b(\d{1,6})[a-z]?\s?[-–&]\s?(\d{1,6})([a-z]?)(?=,?\s+[a-z])")
_FRACTION = re.compile(r"\b(\d{1,6})[\s-]\d/\d\b")
#: How far apart the ends of a range of house numbers may be.
RANGE = 60


def _one_number(m: re.Match) -> str:
    first, last = int(m.group(1)), int(m.group(2))
    return str(first) if first < last <= first + RANGE else m.group(2) + m.group(3)


@lru_cache(maxsize=20_000)
def street_kind(word: str) -> str:
    if word in _kind:
        return _kind[word]
    if len(word) > 4:
        for w in _long_kinds:
            if w[0] == word[0] and edits(word, w, 1) <= 1:
                return _kind[w]
    return ""


def parse_address(text: str | None, place_keys: tuple[str, ...] = ()) -> tuple[str, str, str, str] | None:
    """(house number, street's name, kind, direction) of an address; None where it has no house number on a street.

    Units and floors are left out; a kind or direction that isn't told is ''.
    Of a range of numbers the first counts, of a unit before a number the number, of a number with a fraction the whole.
    """
    s = fold(re.sub("[½¼¾⅓⅔]", r" 1/2", text or ""))
    if not s or _NO_STREET.search(s):
        return None
    s = _UNIT.sub(" , ", s)
    s = _FRACTION.sub(r"\1", _TWO_NUMBERS.sub(_one_number, s))
    chunks = [re.findall(r"[a-z0-9]+", c) for c in re.split(r"[,;]|\s-\s|\s-|-\s", s)]
    chunks = [c for c in chunks if c and "".join(c) not in place_keys]
    words = [w for c in chunks for w in c]
    numbers = [i for i, w in enumerate(words) if re.fullmatch(r"\d{1,6}[a-z]?", w)]
    if not numbers:
        return None
    number = words[numbers[0]]
    rest = [w for i, w in enumerate(words) if i != numbers[0]]
    kind = direction = ""
    own: list[str] = []
    for i, w in enumerate(rest):
        if not direction and w in _direction and (len(w) > 2 or i in (0, len(rest) - 1) or len(w) == 1):
            direction = _direction[w]
        elif not kind and street_kind(w) and not (w in ("st", "ch") and i == 0 and len(rest) > 2 and any(street_kind(v) for v in rest[1:])):
            kind = street_kind(w)
        else:
            own.append(w)
    for key in place_keys:
        for n in (1, 2):
            if key and len(own) > n and "".join(own[-n:]) == key:
                own = own[:-n]
                break
    if not own and kind:  # a street that is named like a kind
        own, kind = [next(w for w in rest if street_kind(w))], ""
    name = "".join(own)
    return (re.sub(r"^0+(?=\d)", "", number), name, kind, direction) if name else None
