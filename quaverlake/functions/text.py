"""Text functions: folding, tokens, keys, defects."""

from __future__ import annotations

import re
import unicodedata
from functools import reduce

import pandas as pd
from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

HAN = r"[\x{3400}-\x{9fff}]"


@F.pandas_udf(T.StringType())
def fold(s: pd.Series) -> pd.Series:
    """NFKD, without combining marks, case-folded."""

    def one(v):
        if v is None:
            return None
        return "".join(c for c in unicodedata.normalize("NFKD", v) if not unicodedata.combining(c)).casefold()

    return s.map(one)


#: Letters that decomposition leaves whole, for search.
_LETTERS = str.maketrans({"æ": "ae", "œ": "oe", "ø": "o", "ł": "l", "ß": "ss"})


#: Traditional characters of names and music with the simplified ones that they are searched as.
_VARIANTS = """
蕭萧 爾尔 羅罗 馬马 亞亚 維维 納纳 貝贝 魯鲁 茲兹 裡里
裏里 葉叶 華华 薩萨 蘇苏 喬乔 奧奥 費费 德德 達达 漢汉
謝谢 馮冯 賽赛 寧宁 賈贾 倫伦 萊莱 門门 蘭兰 諾诺 齊齐
樂乐 鋼钢 練练 習习 變变 圓圆 詠咏 嘆叹 調调
諧谐 謔谑 夢梦 愛爱 憶忆 淚泪 敘叙 獻献 給给 詩诗 聲声
長长 風风 與与 豎竖 簫箫 號号 單单 雙双 協协
麗丽 蓮莲 聖圣 誕诞 莊庄 國国 歐欧 鄉乡 謠谣
來来 歸归 別别 離离 歡欢 鳥鸟 鵝鹅 鵑鹃 鶴鹤 飛飞 龍龙
鄧邓 慶庆 後后 黃黄 紅红 綠绿 藍蓝 銀银 滿满 無无 為为
從从 這这 幾几 歲岁 時时 間间 廣广 場场 邊边 遠远
選选 節节 組组 編编 絃弦 絲丝 紡纺 織织 線线 終终 續续
"""
_SIMPLER = str.maketrans({pair[0]: pair[1] for pair in _VARIANTS.split()})


@F.pandas_udf(T.StringType())
def search_form(s: pd.Series) -> pd.Series:
    """The form in which texts are searched: folded letters and numbers, simplified characters, one space between words, digits apart."""

    def one(v):
        v = unicodedata.normalize("NFKD", v)
        v = "".join(c for c in v if unicodedata.category(c) not in ("Mn", "Sk", "Lm") and c != "·").lower().translate(_SIMPLER).translate(_LETTERS)
        v = re.sub(r"(?<=[^\W\d_])(?=\d)|(?<=\d)(?=[^\W\d_])", " ", v)
        return " ".join(re.findall(r"[^\W_]+", v))

    forms = {v: one(v) for v in s.dropna().unique()}  # a value that repeats in a batch is folded once
    return pd.Series([forms.get(v) for v in s], dtype=object)


def _osa(x: str, y: str, limit: int | None = None, inside: bool = False) -> int:
    """Edits with swaps of neighbours, each place edited once; ``inside``: of the best part of ``y``. Over the limit, limit + 1."""
    if limit is not None and not inside and abs(len(x) - len(y)) > limit:
        return limit + 1
    before, last = [], [0] * (len(y) + 1) if inside else list(range(len(y) + 1))
    for i, c in enumerate(x, 1):
        row = [i]
        for j, d in enumerate(y, 1):
            best = min(last[j] + 1, row[j - 1] + 1, last[j - 1] + (c != d))
            if i > 1 and j > 1 and c == y[j - 2] and x[i - 2] == d:
                best = min(best, before[j - 2] + 1)
            row.append(best)
        if limit is not None and min(row) > limit:
            return limit + 1
        before, last = last, row
    return min(last) if inside else last[-1]


@F.pandas_udf(T.IntegerType())
def osa_distance(a: pd.Series, b: pd.Series) -> pd.Series:
    """Edits with swaps of neighbours, each place edited once (optimal string alignment)."""
    return pd.Series([None if x is None or y is None else _osa(x, y) for x, y in zip(a, b)], dtype="Int32")


_HAN = re.compile(r"[\u3400-\u9fff]+")


@F.pandas_udf(T.IntegerType())
def token_cost(words: pd.Series, terms: pd.Series) -> pd.Series:
    """Edits from a term to a word of the same script, up to 2; a term of Han characters may be any part of the word."""

    def one(word, term):
        if word is None or term is None:
            return None
        han = bool(_HAN.fullmatch(term))
        return 3 if han != bool(_HAN.fullmatch(word)) else _osa(term, word, 2, han)

    return pd.Series([one(w, t) for w, t in zip(words, terms)], dtype="Int32")


def tokens(text: Column) -> Column:
    """Distinct runs of a-z, of Han characters and of digits, in order."""
    return F.array_distinct(F.regexp_extract_all(F.lower(text), F.lit(rf"([a-z]+|{HAN}+|\d+)"), 1))


def composer_key(name: Column) -> Column:
    """``Last, First`` as ``first last`` in lower case with single spaces."""
    parts = F.split(name, ",", 2)
    turned = F.when(F.size(parts) > 1, F.concat_ws(" ", parts[1], parts[0])).otherwise(name)
    return F.trim(F.regexp_replace(F.lower(turned), r"[^a-z0-9]+", " "))


def natural_key(text: Column, width: int = 12) -> Column:
    """Sort key in which runs of digits compare as numbers."""
    padded = F.regexp_replace(F.lower(text), r"(\d+)", "0" * width + "$1")
    return F.regexp_replace(padded, rf"0*(\d{{{width}}})(?!\d)", "$1")


def append_detail(details: Column, value: Column, mark: str = "；") -> Column:
    """A joined list with a value more, each once."""
    return F.array_join(F.array_distinct(F.array_append(F.split(details, mark), value)), mark)


def strip_dates(name: Column) -> Column:
    """A name without its life dates, such as ``(1685-1750)``."""
    return F.trim(F.regexp_replace(name, r"[,(]?\s*\(?\d{4}\s*[-–]\s*(\d{4})?\)?\s*$", ""))


def plain_link(text: Column) -> Column:
    """Wiki links as their labels, without file extensions."""
    text = F.regexp_replace(text, r"\[\[(?:[^\]|]*\|)?([^\]|]*)\]\]", "$1")
    return F.regexp_replace(text, r"(?i)\.(pdf|zip|mxl|mid)$", "")


def category_name(text: Column) -> Column:
    """A category name in lower case; hyphens of any kind and underscores are spaces."""
    return F.trim(F.regexp_replace(F.lower(text), r"[-\x{2010}-\x{2015}_\s]+", " "))


def truncate_utf8(text: Column, limit: int) -> Column:
    """The longest prefix of at most ``limit`` bytes; never cuts a character."""
    cut = F.substring(text.cast("binary"), 1, limit)
    # A cut character leaves a replacement mark at the end, which is dropped.
    shown = F.make_valid_utf8(cut.cast("string"))
    return F.when(F.octet_length(text) <= limit, text).otherwise(F.regexp_replace(shown, "\\x{FFFD}+$", ""))


@F.pandas_udf(T.StringType())
def repair_latin1(s: pd.Series) -> pd.Series:
    """Texts whose UTF-8 bytes were read as Latin-1, repaired where that is reversible."""

    def one(v):
        if v is None or v.isascii():
            return v
        try:
            return v.encode("latin-1").decode("utf-8")
        except UnicodeError:
            return v

    return s.map(one)


def longest_first(text: Column, words: dict[str, str]) -> Column:
    """Replaces dictionary words, longer ones first."""
    for word in sorted(words, key=lambda w: (-len(w), w)):
        text = F.replace(text, F.lit(word), F.lit(words[word]))
    return text


def wrap_title(title: Column) -> Column:
    """A title between book marks, unless it has them all around."""
    return F.when(title.rlike("^《[^《》]*》$"), title).otherwise(F.concat(F.lit("《"), title, F.lit("》")))


#: The longest text that is shown, and what a shown text doesn't have: contacts, links, store paths, digests, files, private paths.
SHOWN = 1600
_UNSAFE = (
    r"[\w.+-]+@[\w-]+\.\w+", r"\+?\d[\d ()-]{8,}\d", r"https?://|www\.|file:", r"(?:sources|objects|metadata)/", r"[a-f0-9]{64}", r"\.(?:pdf|mxl|mid)\b",
    r"(?:^|\s)(?:/(?:users|volumes|tmp|private|home|var)/|[a-z]:[\\/])", r"\bprivate/", r"[\x00-\x08\x0b-\x1f]",
)


def safe_text(text: Column) -> Column:
    """True for a text that may be shown: not blank, not too long, and with nothing of the above."""
    return text.isNotNull() & (F.trim(text) != "") & (F.length(text) <= SHOWN) & ~text.rlike("(?i)" + "|".join(_UNSAFE))


def response_class(body: Column) -> Column:
    """The class of an HTML response by the first of the phrases, in this order, that it has."""
    low = F.lower(body)
    has = lambda *phrases: reduce(lambda a, b: a | b, (F.contains(low, F.lit(p)) for p in phrases))
    # The phrases and the order in which they decide.
    rules = (
        ("human_verification_required", has("verify you are human", "captcha", "bot check")),
        ("login_required", has("please log in", "login required")),
        ("membership_wait_pending", wait_seconds(body).isNotNull()),
        ("membership_required", has("members only", "membership required")),
        ("copyright_restricted", has("copyright restricted", "not public domain")),
        ("region_restricted", has("not available in your country", "regional restriction")),
        ("commercial_only", has("available for purchase", "commercial edition")),
        ("deleted", has("file has been deleted")),
    )
    return F.coalesce(*(F.when(cond, F.lit(name)) for name, cond in rules), F.lit("not_a_pdf"))


def wait_seconds(body: Column) -> Column:
    """The seconds after which a response lets one continue or download, or null."""
    return F.regexp_extract(F.lower(body), r"(?s)(?:continue|download).*?([0-9]+)\s*seconds", 1).try_cast("int")


def due(retry_after: Column, now: Column) -> Column:
    """Whether a retry is due: nothing to wait for, or the time has come."""
    return retry_after.isNull() | (retry_after <= now)


def aware_timestamp(text: Column) -> Column:
    """A timestamp that says its offset from UTC; null for one that doesn't, or for no time at all."""
    fits = text.rlike(r"^\d{4}-\d{2}-\d{2}[T ]\d{2}:\d{2}(:\d{2}(\.\d+)?)?(Z|[+-]\d{2}:?\d{2})$")
    return F.when(fits, F.try_to_timestamp(text))


def canonical_json(text: Column) -> Column:
    """A JSON text with sorted keys and without blanks; null if it isn't JSON or repeats a key."""
    return F.to_json(F.try_parse_json(text))
