"""Pages made of keywords, links or tags in place of sentences.

Each text's features are computed whole, in the workers: shares of its top
words and of repeated n-grams, of duplicate lines and of link text, the density
of separators, and the function words that are missing. What is usual is learnt
from all documents of a language, feature by feature, and a document is
reported if it leaves that range far enough.
"""

from __future__ import annotations

import html
import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import compress
from operator import eq, gt

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from orgloom.session import cut

#: Articles, pronouns, prepositions, conjunctions, auxiliaries and particles of four languages.
FUNCTION_WORDS = {
    "en": "a about above across after again against all also although always am among an and any are around as at be because been before behind being below beneath beside between both but by can cannot could did do does during each either every few for from had has have he her here hers him his how however i if in into is it its itself may me might mine more most much must my near neither no nor not of off on once one only onto or other our ours out over own per please rather shall she should since so some such than that the their theirs them then there these they this those though through to too toward under unless until up upon us very was we were what when where whether which while who whom whose why will with within without would yet you your yours",
    "fr": "a à afin ai ainsi après as au aucun aucune aussi autre autres aux avant avec avoir car ce ceci cela celle celui ces cet cette ceux chaque chez comme comment contre d dans de depuis derrière des dès devant donc dont du elle elles en encore entre es est et étaient était été être eu eux fait il ils j je jusque l la le les leur leurs lors lorsque lui m ma mais malgré me même mes moi moins mon n ne ni non nos notre nous on ont or ou où par parce pas pendant peu peut plus pour pourquoi pourtant près puis puisque qu quand que quel quelle qui quoi s sa sans se selon sera ses si soi son sont sous suis sur ta te tes toi ton tous tout toute toutes très trop tu un une vers voici voilà vos votre vous y",
    "ar": "في على إلى الى عن من مع هذا هذه ذلك تلك هؤلاء التي الذي الذين ما ماذا لا لم لن ليس ليست إن أن إنه أنه أو أم ثم بل لكن كل كان كانت كانوا يكون تكون قد سوف بعد قبل عند عندما حتى أي بين هو هي هم هن نحن أنا أنت كما منذ خلال حول ضد دون غير إذا إذ لو لولا لدى لعل حيث بعض كذلك هناك هنا كيف متى أين لماذا لأن فقط أيضا عبر نحو أمام خلف فوق تحت جدا",
    "ur": "کے کی کا کو میں سے پر ہے ہیں ہوں اور نے یہ وہ اس ان تھا تھی تھے تھیں تک بھی ایک ہر یا کہ جو جس جن اپنے اپنی اپنا ہم آپ تم مجھے ہمیں انہیں ہو گا گی گے کر کیا کیے گیا گئی گئے رہا رہی رہے ہوا ہوئی ہوئے ہوتا ہوتی ہوتے سکتے سکتا سکتی جا جائے نہیں نہ کوئی کچھ جب تب تو اگر مگر لیکن بلکہ پھر پہلے بعد ساتھ والے والی والا ہی کیوں کیسے کہاں کب یہاں وہاں ہمارے ہمارا ہماری جیسے لیے بغیر درمیان بارے",
}
_marks = re.compile(r"[̀-ًͯ-ْٰ]")
_plain_letters = str.maketrans("àâäéèêëîïôöùûüç", "aaaeeeeiioouuuc")


def _bare_word(word: str) -> str:
    w = word.lower().replace("’", "'")
    w = w.rsplit("'", 1)[-1] if len(w) > 2 and w[1:2] == "'" else w  # l'imam
    return _marks.sub("", w) if not w.isascii() else w


_language: dict[str, str] = {}
for _code, _words in FUNCTION_WORDS.items():
    for _w in _words.split():
        _language.setdefault(_bare_word(_w), _code)
        _language.setdefault(_bare_word(_w).translate(_plain_letters), _code)
#: What Arabic joins to a function word: conjunctions and prepositions before it, pronouns behind it.
_AR_BEFORE, _AR_BEHIND = "وفبلك", ["ه", "ها", "هم", "هن", "هما", "نا", "ك", "كم", "ي"]
_ar_stems = {"في", "على", "علي", "إلى", "إلي", "عن", "من", "مع", "ل", "ب", "بين", "عند", "لدي", "أن", "إن", "كل", "بعض", "قبل", "بعد", "حول"}
_function = set(_language)

_anchor = re.compile(r"<a\b[^>]*>(.*?)</a\s*>", re.S | re.I)
_markdown = re.compile(r"\[([^\]\n]*)\]\(\s*[^)\s]+\s*\)")
_url = re.compile(r"(?:https?://|www\.)[^\s<>\"')\]]+|(?<![@\w.-])(?:[a-z0-9][a-z0-9-]*\.)+[a-z]{2,12}(?:/[^\s<>\"')\]]*)(?=[\s<>\"')\],;|]|$)|(?<![@\w.-])(?:[a-z0-9][a-z0-9-]*\.)+(?:com|org|net|info|biz|test|example|ca)\b(?!@)", re.I)
_tag = re.compile(r"<[^<>]+>")
_hash = re.compile(r"#[\w-]{2,}")
_count = re.compile(r"\(\d+\)")
_separator = re.compile(r"[^\w\s'’]+|_+|[ \t]{2,}")
_word = re.compile(r"[^\W_]+(?:['’][^\W_]+)?")
FEATURES = ["n_words", "link_share", "hash_share", "function_share", "free_share", "digit_share", "top_share", "gram_share", "line_share", "separators", "bare_share"]
#: Words of a window, and digits in one that still may be keywords.
WINDOW, WINDOW_DIGITS = 10, 2
#: How often an n-gram must stand in a text to be a repeated one, by its length.
REPEATED = {2: 3, 3: 3, 4: 2}
#: Function words of a language among all words, below which the language isn't told.
TOLD = 0.06


def is_function_word(word: str) -> bool:
    """Whether a folded word is a function word, in Arabic also with what is joined to it."""
    if word in _function:
        return True
    if len(word) > 1 and "؀" <= word[0] <= "ۿ":
        if word[0] in "وف" and is_function_word(word[1:]):
            return True
        for end in _AR_BEHIND:
            if word.endswith(end) and word[: -len(end)] in _ar_stems:
                return True
    return False


def features(text: str | None, memory: dict[str, tuple] | None = None) -> tuple[str, list[float]]:
    """(language, features in the order of FEATURES) of a text; all 0 for null, empty and blank texts.

    The language is the one most function words are of, '' where there are next to none.
    ``link_share``: characters of addresses, their markup and the words they
    stand behind, ``hash_share`` of tags, of all characters that aren't white
    space. Of all words: ``function_share`` function words, ``free_share`` those
    of them that stand in no repeated n-gram, ``digit_share`` numbers,
    ``top_share`` the five commonest other words, ``gram_share`` words in
    repeated n-grams of two to four words, ``line_share`` words in lines met
    before, ``separators`` signs and line breaks between words,
    ``bare_share`` words in windows without any function word and with few
    numbers.
    """
    raw = html.unescape(text or "")
    solid = sum(map(len, raw.split()))
    if not solid:
        return "", [0.0] * len(FEATURES)
    links = 0

    def take(m: re.Match) -> str:
        nonlocal links
        label = _tag.sub(" ", m.group(1))
        if sum(is_function_word(_bare_word(w)) for w in _word.findall(label)) > 2:
            return f" {label} "  # a sentence that happens to be a link
        links += sum(map(len, m.group(0).split()))
        return " "

    def address(m: re.Match) -> str:
        nonlocal links
        links += len(m.group(0))
        return " "

    rest = raw
    if "<" in rest:
        rest = _anchor.sub(take, rest)
    if "](" in rest:
        rest = _markdown.sub(take, rest)
    if "." in rest:
        rest = _url.sub(address, rest)
    if "<" in rest:
        rest = _tag.sub(" ", rest)
    hashes = 0
    if "#" in rest:
        hashes = sum(map(len, _hash.findall(rest)))
        rest = _hash.sub(" ", rest)
    if "(" in rest:
        rest = _count.sub(" ; ", rest)
    rest = rest.lower() if rest.isascii() else _marks.sub("", rest).lower()
    memory = {} if memory is None else memory
    words: list[str] = []
    seen: set[str] = set()
    signs = again = 0
    for line in rest.splitlines():
        found = _word.findall(line.replace("_", " "))
        if not found:
            continue
        signs += len(_separator.findall(line.rstrip(" .!?…:;,»|-•/·*"))) + 1
        key = " ".join(found)
        if key in seen:
            again += len(found)
        seen.add(key)
        words += found
    n = len(words)
    if not n:
        return "", [0.0, links / solid, hashes / solid] + [0.0] * (len(FEATURES) - 3)
    if len(memory) > 100_000:
        memory.clear()
    for w in set(words):
        if w not in memory:
            bare = _bare_word(w)
            code = _language.get(bare) or ("ar" if is_function_word(bare) else "")
            memory[w] = (code, bare, bool(code), not code and w[0].isdigit())
    kinds = [memory[w] for w in words]
    words = [k[1] for k in kinds]
    function, number = [k[2] for k in kinds], [k[3] for k in kinds]
    content = list(map(eq, function, number))  # neither; no word is both
    spoken = Counter([k[0] for k in kinds])
    del spoken[""]
    best, hits = spoken.most_common(1)[0] if spoken else ("", 0)
    language = best if hits >= TOLD * n and hits > (1 if n > 12 else 0) else ""
    top = sum(c for _, c in Counter(compress(words, content)).most_common(5) if c > 2)
    covered = _repeated(words, content)
    free = sum(map(gt, function, covered))
    return language, [float(n), links / solid, hashes / solid, sum(function) / n, free / n, sum(number) / n, top / n, sum(covered) / n, again / n, signs / n, _bare(function, number) / n]


def _repeated(words: list[str], content: list[bool]) -> list[bool]:
    """Which words stand in an n-gram that comes again as often as ``REPEATED`` asks, with two words at least that are no function words."""
    covered = [False] * len(words)
    grams = list(zip(words, words[1:]))
    counts = Counter(grams)
    at = [i for i, gram in enumerate(grams) if counts[gram] > 1]
    for i in at:
        if counts[grams[i]] >= REPEATED[2] and content[i] and content[i + 1]:
            covered[i] = covered[i + 1] = True
    for size in (3, 4):
        # a longer one can only come again where both shorter ones in it do
        shorter = set(at)
        longer = {i: tuple(words[i : i + size]) for i in at if i + 1 in shorter}
        counts = Counter(longer.values())
        at = [i for i, gram in longer.items() if counts[gram] > 1]
        for i in at:
            if counts[longer[i]] >= REPEATED[size] and sum(content[i : i + size]) > 1:
                covered[i : i + size] = [True] * size
    return covered


def _bare(function: list[bool], number: list[bool]) -> int:
    """How many words stand in windows of ``WINDOW`` words (or the whole of a shorter text) without function words and with few numbers."""
    n, total, start = len(function), 0, 0
    width = min(WINDOW, n)
    ends = [i for i, f in enumerate(function) if f] + [n]
    for end in ends:
        if end - start >= width:
            digits, upto = sum(number[start : start + width - 1]), start  # words before upto are counted
            for i in range(start + width - 1, end):
                digits += number[i]
                if digits <= WINDOW_DIGITS:
                    total += i + 1 - max(upto, i + 1 - width)
                    upto = i + 1
                digits -= number[i + 1 - width]
        start = end + 1
    return total


def document_features(documents: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """``id_col``, ``language`` and the features of every row."""
    kind = documents.schema[id_col].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        memory: dict[str, tuple] = {}
        for batch in batches:
            for at in range(0, batch.num_rows, 256):
                part = batch.slice(at, 256)
                found = [features(t, memory) for t in part.column(1).to_pylist()]
                columns = [pa.array([v[i] for _, v in found], pa.float64()) for i in range(len(FEATURES))]
                yield pa.RecordBatch.from_arrays([part.column(0), pa.array([x for x, _ in found], pa.string()), *columns], names=[id_col, "language", *FEATURES])

    rows = documents.select(F.col(id_col).alias(id_col), F.col(text_col).cast("string").alias("__text"))
    return rows.mapInArrow(run, f"`{id_col}` {kind}, language string, " + ", ".join(f"{f} double" for f in FEATURES))


#: Calibrated features: spreads above a language's median that are out of the usual, and the least and greatest threshold.
LIMITS = {"top_share": (6, 0.15, 0.5), "gram_share": (3, 0.3, 0.9), "line_share": (4, 0.3, 0.9), "separators": (3, 0.2, 0.5), "bare_share": (3, 0.5, 0.9)}
#: What ``top_share`` alone must reach, in the same way; and how far below the median separators are missing.
FAR_TOP, NO_SEPARATORS = (12, 0.35, 0.6), 4
#: Languages with fewer texts of ``LONG`` words take the figures of all texts.
LEAST_TEXTS, LONG = 30, 20


def usual_features(seen: DataFrame) -> DataFrame:
    """``language`` and the quartiles of each calibrated feature over its texts of ``LONG`` words; at most one row for each of ``FUNCTION_WORDS`` and one for '' (all texts)."""
    names = ["function_share", *LIMITS]
    quartiles = [F.percentile_approx(c, [0.25, 0.5, 0.75], 10_000).alias(c) for c in names]
    long = seen.filter(F.col("n_words") >= LONG)
    of_language = long.filter("language <> ''").groupBy("language").agg(F.count(F.lit(1)).alias("texts"), *quartiles).filter(F.col("texts") >= LEAST_TEXTS).drop("texts")
    return of_language.unionByName(long.agg(*quartiles).select(F.lit("").alias("language"), *names))


def _by_language(usual: dict[str, dict], of: Callable[[dict], float]) -> Column:
    """A figure made of a language's quartiles, of all texts' for other languages."""
    named = [F.lit(x) for language, q in usual.items() if language for x in (language, of(q))]
    rest = F.lit(of(usual.get("", {})))
    return F.coalesce(F.create_map(*named)[F.col("language")], rest) if named else rest


def _bound(feature: str, spreads: float, least: float, most: float) -> Callable[[dict], float]:
    def of(quartiles: dict) -> float:
        q = quartiles.get(feature)
        return float(max(min(q[1] + spreads * (q[2] - q[1]), most), least)) if q else least

    return of


def stuffed(documents: DataFrame, id_col: str, text_col: str, marked: float = 0.5, few: float = 0.6, digits: float = 0.13) -> DataFrame:
    """Ids of documents most of whose text is keywords, links or tags.

    Every threshold but those on links and digits is learnt for each language
    from the quartiles over all its documents; texts of no known language are
    held against all texts, and as nothing tells what their function words are,
    only repetition, separators and links count for them. A document is reported
    - if links and tags are ``marked`` of it, and function words are scarcer than they;
    - if bare keywords fill it (windows without function words), with less than ``few`` of the
      usual function words, and separators or top words are out of the usual;
    - if top words, n-grams or lines come again out of the usual while function words
      are missing, or far out of it;
    - if nearly all of it is one passage repeated.
    Texts full of numbers (timetables, directories, prices) aren't reported for
    keywords. Null, empty and blank texts, and texts of under twelve words
    without links or tags aren't reported; a repeated id is reported once; null
    ids aren't. Other columns are ignored.
    """
    seen = cut(document_features(documents, id_col, text_col))
    usual = {r.language: r.asDict() for r in usual_features(seen).collect()}  # at most five rows
    told, n = F.col("language") != "", F.col("n_words")
    above = lambda feature, limit: F.col(feature) >= _by_language(usual, _bound(feature, *limit))
    median = lambda q: float(max(q["function_share"][1], 0.05)) if q.get("function_share") else 0.05
    rows = seen.withColumn("few", F.when(told, F.col("function_share") / _by_language(usual, median)).otherwise(0.0))
    top, gram, line, apart = (above(c, LIMITS[c]) for c in ("top_share", "gram_share", "line_share", "separators"))
    far = above("top_share", FAR_TOP)
    none = lambda q: float(max(q["separators"][1] - NO_SEPARATORS * (q["separators"][1] - q["separators"][0]), 0.04)) if q.get("separators") else 0.04
    run_on = (n >= 40) & (F.col("separators") < _by_language(usual, none))
    links = F.col("link_share") + F.col("hash_share")
    heap = links + (1 - F.least(links, F.lit(1.0))) * F.when(n >= 5, F.col("bare_share")).otherwise(0.0)
    plain = F.col("digit_share") < digits
    linked = (links >= marked) & ((F.col("few") < links) | (links >= 0.8) | (n < 25))
    # a line of names has few function words; a heap has next to none
    scarce = F.col("few") < F.when(n < 40, 0.35).otherwise(few)
    heaped = above("bare_share", LIMITS["bare_share"]) | ((links > 0) & (heap >= marked))
    heaped = heaped & scarce & plain & ((n >= 12) | (links > 0)) & (apart | run_on | far | (links >= 0.3) | (told & (top | (F.col("few") < 0.2))))
    signs = lambda *s: sum((x.cast("int") for x in s), F.lit(0))
    repetitive = (told & (signs(top, gram, line) >= 1) & (F.col("few") < 0.5)) | ((signs(top, gram, line, apart) >= 2) & (F.col("few") < 0.65))
    repetitive = repetitive | (far & told & (F.col("few") < 0.75)) | (far & (F.col("gram_share") >= 0.6) & (F.col("digit_share") < 0.06))
    repetitive = repetitive & plain & (n >= 12)
    one_passage = (links < 0.1) & (F.col("line_share") >= 0.6) & (F.col("gram_share") >= 0.9) & (n >= 30)
    return rows.filter(F.col(id_col).isNotNull() & (linked | heaped | repetitive | one_passage)).select(id_col).distinct()
