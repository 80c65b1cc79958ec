"""Template residue and error-page text: documents that hold no content of their own.

Every document is cut into visible segments - markup, response headers, page furniture and comment
marks are taken off - and each segment is explained, if it can be, by a detector: status titles,
access and error messages, notices that scripts are required, filler, slots of forms never filled
in. Slug (path), title and body are compared: a file whose own name says that it deals with such
texts (errors, translations, templates) is left alone if it has anything beside them, and titles do
not count as body.

Segments that no detector knows are settled by host evidence, counted over all documents, with and
without residue: beside detected residue, wording that recurs over several unrelated hosts and does
not match the slug, or a title that agrees with the slug, is fixed wording around such messages. A
document is residue if nothing else is left of it. A text in which no detector hits (a wording or
language they do not know) is residue if its whole body recurs over several hosts under as many file
names, and neither body nor title matches the slug; copies of one file keep its name, and texts that
hold code or nothing but comments are files of their own.

Defined cases: null, empty and blank texts are no residue; null paths and hosts match nothing;
repeated documents come out each, and copies on one host count once as evidence; texts of any
length are read to their end, unless code was met, which no evidence explains.
"""

from __future__ import annotations

import hashlib
import html
import json
import math
import re
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallymark.session import materialise, spread

#: Hosts over which unknown wording must recur to count as fixed wording: so many, and this share of all hosts.
LEAST_HOSTS, HOST_SHARE = 4, 1e-4
#: Slots of the filter of wordings whose hosts are counted over all documents: bounds what the driver and tasks hold.
WORDING_SLOTS = 2**18

# Reason phrases of HTTP and common spellings of them.
STATUS = (
    "moved permanently|temporary redirect|permanent redirect|bad request|unauthorized|payment required|forbidden|not found|"
    "file not found|page not found|object not found|no such key|method not allowed|not acceptable|proxy authentication required|request timeout|request time-out|gone|length required|"
    "precondition failed|payload too large|uri too long|unsupported media type|range not satisfiable|expectation failed|misdirected request|unprocessable entity|failed dependency|too early|"
    "upgrade required|precondition required|too many requests|request header fields too large|unavailable for legal reasons|internal server error|server error|not implemented|bad gateway|"
    "service unavailable|service temporarily unavailable|gateway timeout|gateway time-out|http version not supported|network authentication required|access denied|error|oops|hmm|sorry|"
    "something went wrong|whoops|attention required|just a moment|sign in|log in|login|signin"
).split("|")
_COMPACT = {re.sub(r"[^a-z]", "", s) for s in STATUS}
# Page furniture.
FURNITURE = set(
    "skip to content|skip to main content|sign in|sign up|log in|login|register|help|home|back|retry|reload|try again|go back|terms|privacy|contact|about|status|search|menu|cookies|imprint|name|word|"
    "password|user|username|email|zurück|zur startseite|start|startseite|retour|accueil|volver|inicio|voltar|назад|戻る|返回|support|docs|blog|pricing|loading|all rights reserved|powered by".split("|")
)
LOREM = frozenset(
    "lorem ipsum dolor sit amet consectetur consectetuer adipiscing adipisicing elit sed do eiusmod tempor incididunt ut labore et dolore magna aliqua enim ad minim veniam quis nostrud exercitation "
    "ullamco laboris nisi aliquip ex ea commodo consequat duis aute irure in reprehenderit voluptate velit esse cillum eu fugiat nulla pariatur excepteur sint occaecat cupidatat non proident sunt culpa "
    "qui officia deserunt mollit anim id est laborum".split()
)
_FORM_WORDS = (
    "author|authors|author name|name|full name|your name|user|username|email|e mail|mail|year|date|version|project|project name|project title|package|package name|module|module name|license|licence|"
    "license name|licence name|organisation|organization|company|company name|maintainer|maintainers|owner|copyright holder|copyright owner|holder|fullname|description|short description|long description|"
    "summary|short summary|repo|repo url|repo name|repository|repository url|url|homepage|website|entry point|entrypoint|main|title|subject|body|address|phone|city|country|keywords|tagline|program|product|"
    "product name|app|app name|application|client|customer|recipient|sender|signature|first name|last name|department|team|contact|contact email|role|position|amount|number|month|day|place|reason|topic|text|value|placeholder"
)
FORM_FIELDS = frozenset(_FORM_WORDS.split("|"))
_ANGLE_TAGS = frozenset("title address summary main body text code name label form header footer nav section article email".split()) - {"email"}
_SLOT = re.compile(
    r"\{\{\s*([\w ./-]{1,40}?)\s*\}\}|\{%\s*([\w ./-]{1,40}?)\s*%\}|<%=?\s*([\w ./-]{1,40}?)\s*%>|\$\{\s*([\w ./-]{1,40}?)\s*\}|#\{\s*([\w ./-]{1,40}?)\s*\}|\$\(\s*([\w ./-]{1,40}?)\s*\)|"
    r"%%\s*([\w ./-]{1,40}?)\s*%%|@@\s*([\w ./-]{1,40}?)\s*@@|\[\[\s*([\w ./-]{1,40}?)\s*\]\]|«\s*([\w ./-]{1,40}?)\s*»|__([A-Z][A-Z_]{1,38}[A-Z])__|<([A-Za-z][A-Za-z _-]{1,40})>|"
    r"\[([A-Z][A-Z _-]{2,40}|(?:your|insert) [a-z _-]{2,40})\]|\{([A-Za-z][A-Za-z_ ]{1,30})\}"
)
#: Slots without brackets: apart, so that the pattern above starts with one of a few signs and is searched fast.
_WORD_SLOT = re.compile(r"\b(YOUR_[A-Z_]{2,40})\b|\b(?:INSERT|ENTER|ADD)_([A-Z_]{2,40})\b")
#: What stands for a slot in a segment.
HOLE = "␟"

_MESSAGES = [
    # access, absence, failure
    r"(page|site|file|resource|document|url|link|object|repository|project|content|item|address)\b.{0,60}\b(not|no longer|cannot|could ?n.t|can.t|never) (be )?(found|exists?|available|accessible|displayed|reached|loaded)",
    r"\b(page|file|url|document|resource)\b.{0,40}\b(was not found|has moved|is missing|does not exist|has been (removed|deleted|disabled|moved))",
    r"\b(repository|project|account|page|site|content)\b.{0,40}\b(disabled|removed|deleted|suspended|taken down)\b",
    r"\b(access|permission)\b.{0,50}\b(denied|forbidden|refused|required)|\b(do not|don.t|no) (have )?(the )?(permission|access|rights?)\b|not (authori[sz]ed|allowed) to (view|access)",
    r"\b(rate limit|too many requests|quota)\b.{0,50}(exceeded|reached|address|wait)|please wait before|\b(wait|try again|retry)\b.{0,30}\b(minutes?|later|moment|retry)\b",
    r"\b(server|host|upstream|gateway|backend|service|origin)\b.{0,50}\b(did not respond|not respond(ing)?|took too long|is down|unreachable|unavailable|not available|timed out|too long to answer|overloaded|busy)",
    r"\bdown for maintenance|under maintenance|be (right )?back (soon|shortly)|something went wrong|unexpected error|error (has )?occurred|internal error|went wrong on our",
    r"\b(sign|log) ?in to (continue|view|see|access)|please (sign|log) ?in|login required|session (has )?expired|contact the (owner|administrator)",
    r"\((\d+)\) (timed out|connection refused|no address|could not|couldn.t|failed|host|unable)|^(get|fetch|curl|wget|ssh|git)\b.{0,20}\b(timed out|connection refused|no address found|could not resolve|unable to|failed to|connection reset)",
    # scripts
    r"\b(javascript|java script|cookies?|scripts?)\b.{0,60}\b(enable[sd]?|disabled|required|requires?|needed?|needs?|turn(ed)?|switch(ed)?|allow(ed)?|activate[sd]?|must|on)\b",
    r"\b(enable|activate|allow|turn on|switch on|requires?|needs?|without|use)\b.{0,40}\b(javascript|cookies|scripts)\b|turn it on and reload|\breload (the|this) page\b",
    r"javascript.{0,40}(aktivier|benötig|erforderlich|activ|habilit|ative|nécessaire|requis|необходим|включ|有効|启用|啟用|必要|需要)|(aktivier|benötig|activ|habilit|ativ|nécessite|requiert|включ|有効|启用|啟用|请开启).{0,40}javascript",
    r"checking your browser|no robot|not a robot|are (a )?human|verify(ing)? (that )?you|captcha|ddos protection|browser (is )?(not supported|out of date|does not)",
    r"loading .{0,30}…|if nothing appears",
    # other languages
    r"(seite|datei|dienst|zugriff|server).{0,50}(nicht gefunden|nicht erreichbar|nicht verfügbar|verweigert|existiert nicht)|versuchen sie es später",
    r"(page|document|fichier|accès|service).{0,40}(introuvable|n'existe|refusé|indisponible|momentanément)|veuillez réessayer",
    r"(página|archivo|fichero|acceso|servidor|serviço|servicio).{0,50}(no se encontr|no encontrad|solicitada|denegado|não encontrad|indisponível|no disponible|inténtelo)|no se encontró|error interno|inténtelo más tarde|tente novamente",
    r"(страница|файл|доступ|сервер|сервис|сайт).{0,40}(не найден|запрещ|недоступ|удал)|не найдена|попробуйте позже",
    r"(ページ|ファイル|サーバ).{0,20}(見つかりません|存在しません|表示できません)|見つかりませんでした|アクセス.{0,10}(拒否|できません)|页面.{0,8}(不存在|已被删除|未找到)|不存在或已被删除|无法访问|拒绝访问|頁面不存在",
]
_MESSAGE = re.compile("|".join(f"(?:{m})" for m in _MESSAGES))
_FILLER = re.compile(
    r"^(tbd|tba|tbc|todo|fixme|n/?a|wip|to be (written|done|added|completed|announced|determined)|coming soon|under construction|work in progress|blah( blah)*|(asdf|qwerty|foo|bar|baz|test|text|lorem|x{2,}|abc|hello)( (asdf|qwerty|foo|bar|baz|qux|test|text|lorem|x{2,}|abc|hello))*|"
    r"(add|insert|put|enter|write|type|place) (your |some |the |any )?(content|text|description|title|body|body copy|copy|code|something|name|details|info)\b.{0,40}|your (text|description|content|title|name|code|copy)( goes)? here|(sample|placeholder|dummy|example|filler) (text|content|copy|data)\b.{0,30}|"
    r"(text|content|description|copy) goes here|write something.{0,40}|replace (me|this|with).{0,30}|change ?me|texto de (ejemplo|exemplo|relleno)|texte (à compléter|d'exemple|de remplissage)|(hier steht|hier kommt|hier folgt).{0,30}|platzhalter.{0,20}|beispieltext|testo di esempio|текст.{0,20}(примера|заполн).{0,20}|"
    r"ここに.{0,20}|在此.{0,20}|示例文本|占位.{0,10}|set this|fill (this|me) in.{0,20})$"
)
#: Every ASCII message holds one of these words.
_HINTS = frozenset(
    "page site file resource document url link object repository project content item address access permission authorized authorised allowed rate limit quota requests wait try retry server host "
    "upstream gateway backend service origin maintenance back soon went unexpected error internal sign log login session expired contact timed connection refused found resolve unable failed javascript java "
    "script scripts cookies reload browser robot human verify captcha ddos loading nothing seite datei dienst zugriff introuvable document fichier veuillez solicitada archivo fichero acceso servidor "
    "servicio interno tente get fetch curl wget ssh git".split()
)
#: A first line that says where a copy was taken from.
_ORIGIN = re.compile(r"(?i)^\W*(mirrored|saved|fetched|downloaded|archived|retrieved|crawled|snapshot|captured|cached)\b.{0,80}$")
#: Slug words of files that deal with such texts themselves.
_OWN_SLUG = re.compile(r"(?i)(?:^|/)(?:i18n|l10n|locales?|lang|translations?|templates?|render|fixtures?|errors?)/|(?:^|[/_.-])(?:errors?|status|messages?|faq|troubleshooting|noscript|placeholders?|lorem|wrap|gen_text|render|fill|i18n|template)[_.-]?[a-z]*\.\w+$")
_DROPPED = re.compile(r"(?is)<(style|script|nav|footer|label|address|select|svg|requestid|hostid)\b.*?</\1\s*>|<!--.*?-->|<!\[cdata\[|\]\]>")
_TITLE = re.compile(r"(?is)<(title|h1)\b[^<>]*>(.*?)</\1\s*>")
_TAG = re.compile(r"</?[a-zA-Z!?][^<>]{0,2000}>")
_HOSTNAME = re.compile(r"\b(?:[a-z0-9-]+\.)+(?:test|invalid|example|com|org|net|io|local)\b(?::\d+)?", re.I)
_HEX_RUN = re.compile(r"[0-9a-f]{6,}")
_MARK = re.compile(r"^(?:\s*(?:#+|//+|--+|/?\*+/?|;+|%+|>+|\"\"\"|'''|[-+•·]))*\s*")
_COMMENT = re.compile(r"\s*(?:#|//|--|/?\*|;|%|\"\"\"|'''|<!)")
_MARK_END = re.compile(r"\s*(?:\*/|-->)\s*$")
_SENTENCE = re.compile(r"(?<=[.!?。！？])\s+|(?<=[。！？])|\s+[|·–—]\s+|\s*\|\s*")
_WORD = re.compile(r"[^\W\d_]+")
_HEADER = re.compile(r"^[A-Za-z][A-Za-z-]{1,40}:\s.*$")
_BRACKET = re.compile(r"[{}=<>\[\]]")
_CALL = re.compile(r"\w\(|\(\)|;\s*$")
#: Holds wherever _SENTENCE does, and is found faster.
_BREAK = re.compile(r"[.!?]\s|[。！？|]|\s[·–—]\s")
_CODE = re.compile(r"[{}();=<>\[\]]|^\s*(?:import|from|package|export|def|class|return|const|let|var|function)\b")


def _plain_code(line: str) -> bool:
    return bool(_BRACKET.search(line)) or ("(" in line or ";" in line) and bool(_CALL.search(line))


def _sentences(line: str) -> list[str]:
    return _SENTENCE.split(line) if _BREAK.search(line) else [line]


def _key(m: re.Match) -> str:
    """0 for a key of six or more hexadecimal signs with a digit, standing by itself."""
    t, (i, j) = m.string, m.span()
    inside = i and (t[i - 1].isalnum() or t[i - 1] == "_") or j < len(t) and (t[j].isalnum() or t[j] == "_")
    return m[0] if inside or m[0].isalpha() else "0"


def _field(inner: str) -> bool:
    t = re.sub(r"[_./-]+", " ", inner).strip().lower()
    t = re.sub(r"^(your|insert|enter|the|my|add)\s+|\s+(here)$", "", t)
    t = re.sub(r"^(your|insert|enter|the|my|add)\s+|\s+(here)$", "", t)
    return t in FORM_FIELDS


def _holes(text: str) -> tuple[str, int, int]:
    """Text with slots of form fields replaced, their number, and the number of other slots."""
    fields = others = 0

    def one(m: re.Match) -> str:
        nonlocal fields, others
        inner = m[m.lastindex]
        angle = m[0][0] == "<" and m[0][1] != "%"
        if angle and inner.lower() in _ANGLE_TAGS or not _field(inner):
            others += not angle
            return m[0]
        fields += 1
        return HOLE

    text = _SLOT.sub(one, text)
    if "YOUR_" in text or "T_" in text or "R_" in text or "ADD_" in text:
        text = _WORD_SLOT.sub(one, text)
    return text, fields, others


class Verdict:
    __slots__ = ("evidence", "unknown", "titles", "own", "form", "mute")

    def __init__(self):
        self.evidence, self.unknown, self.titles, self.own, self.form, self.mute = 0, [], [], False, False, False


def _explain(s: str, form: bool) -> str | None:
    """Kind of a segment: ''. nothing to explain; status, message, filler, form, furniture; None: unknown."""
    s = _HEX_RUN.sub(lambda m: " " if _key(m) == "0" else m[0], _HOSTNAME.sub(" ", s) if "." in s else s).strip()
    t = " ".join(s.lower().split()).strip(" .,:;!?…-–—*_`'\"()[]{}/\\=&©#")
    words = _WORD.findall(t)
    if not words:
        return "form" if HOLE in s else ""
    if HOLE in s:
        return "form" if form else None
    if _plain_code(s):
        return None
    if t in FURNITURE:
        return "furniture"
    compact = re.sub(r"[^a-z]", "", t)
    if compact in _COMPACT or re.fullmatch(r"(?:http/[\d.]+ )?(?:error )?\d{3}\b.*", t) and re.sub(r"^(http|error)+", "", compact) in _COMPACT | {""}:
        return "status"
    if _FILLER.match(t):
        return "filler"
    if len(words) > 1 and sum(w in LOREM for w in words) >= 0.8 * len(words):
        return "filler"
    if len(words) <= 30 and (not t.isascii() or not _HINTS.isdisjoint(words)) and _MESSAGE.search(t):
        return "message"
    if re.fullmatch(r"(ray|trace|ref|request|error|incident|event|reference|correlation|support) ?(id|code|number)?|\w+ (code viewer|viewer|hub|code host|pages)|(copyright|©|\(c\)).{0,60}|server|content type text html", t):
        return "furniture"
    return None


def _visible(t: str, titles: list[str]) -> list[str]:
    """Visible lines of a text; its titles are put apart."""
    if t[:5] in ("HTTP/", "http/"):
        head, _, body = t.replace("\r\n", "\n").partition("\n\n")
        lines = head.split("\n")
        t = "\n".join([lines[0], *[x for x in lines[1:] if not _HEADER.match(x)], body])
    pieces: list[str] | None = None
    if t[:1] in ("{", "["):
        try:
            stack, pieces = [json.loads(t)], []
            while stack:
                x = stack.pop()
                if isinstance(x, dict):
                    stack += [y for k, y in x.items() if not re.search(r"(?i)(?:^|_)(?:id|uuid|request|trace|code|url|href)$", k)]
                elif isinstance(x, list):
                    stack += x
                elif isinstance(x, str):
                    pieces.append(x)
        except (ValueError, RecursionError):
            pieces = None
    if pieces is None:
        if "<" in t and re.search(r"<[a-zA-Z!?/]", t):
            t = _DROPPED.sub("\n", t)

            def title(m: re.Match) -> str:
                titles.append(_TAG.sub(" ", m[2]))
                return "\n"

            t = _TITLE.sub(title, t)
            t = html.unescape(_TAG.sub("\n", t))
        pieces = t.splitlines()
    return pieces


def _bare(p: str) -> str:
    """A line without marks of comments, lists and headings."""
    p = p[_MARK.match(p).end() :]
    return _MARK_END.sub("", p) if p.endswith(("*/", "-->", " ")) else p


def judge(text: str, path: str | None = None) -> Verdict:
    """Evidence of residue in a text, and the segments that no detector explains. mute: the whole text
    was read, and there is neither evidence nor code nor a comment alone."""
    v = Verdict()
    v.own = bool(path and _OWN_SLUG.search(path))
    t = text.lstrip("﻿ \t\r\n")
    if not t or v.own:
        v.own = True
        return v
    filled, fields, others = _holes(t)
    form = v.form = fields >= 2 and others <= fields // 4
    if form:
        t = filled
    pieces = []
    for marked in _visible(t, v.titles):
        p = _bare(marked)
        if p:
            # Code stays unknown, whatever its host evidence: a file that has any is settled, and nothing else is asked.
            if not form and _plain_code(p) and HOLE not in p and (len(pieces) > 1 or not _ORIGIN.match(p)) and _WORD.search(p) and _CODE.search(wording(p)):
                v.own = True
                return v
            pieces.append((marked, p))
    for title in v.titles:
        kind = _explain(title, form)
        if kind is None and any(_explain(x, form) == "status" for x in re.split(r"\s*[-–—|:]\s*", title)):
            kind = "status"
        v.evidence += kind in ("status", "message", "filler", "form") or bool(re.fullmatch(r"\W*[45]\d\d\W*", title))
    at, plain = 0, False
    for marked, p in pieces:
        at += 1
        if at <= 2 and (_ORIGIN.match(p) or at == 1 and marked.startswith("# ") and len(p.split()) <= 4 and _explain(p, form) is None):
            v.titles.append(p)  # where it was copied from, or the heading of a page of text
            continue
        if not _WORD.search(p) and HOLE not in p:
            continue
        plain |= not _COMMENT.match(marked)
        code = HOLE not in p and _plain_code(p)
        for s in [p] if code else _sentences(p):
            kind = None if code else _explain(s, form)
            if kind is None:
                v.unknown.append(s)
                if not form and _CODE.search(wording(s)):  # code stays unknown, whatever its host evidence
                    v.own = True
                    return v
            else:
                v.evidence += kind in ("status", "message", "filler", "form")
    if not v.evidence:
        v.own, v.mute = True, plain and bool(v.unknown) and not t.startswith("#!")
    return v


_DIGITS = re.compile(r"\d+")


def _masked(text: str) -> str:
    return _DIGITS.sub("0", _HEX_RUN.sub(_key, text.lower()))


def wording(segment: str) -> str:
    """A segment as host evidence counts it: lower case, numbers and keys masked."""
    return " ".join(_masked(segment).split()).strip(" .,:;!?…\"'")


def _slug_terms(path: str | None, repo: str | None) -> set[str]:
    t = re.sub(r"([a-z])([A-Z])", r"\1 \2", f"{path or ''} {repo or ''}").lower()
    return {w for w in _WORD.findall(t) if len(w) > 3}


def _agreed(titles: list[str], slug: set[str]) -> set[str]:
    """Terms of the titles that agree with the slug."""
    terms = [{w for w in _WORD.findall(x.lower()) if len(w) > 3} for x in titles]
    return set().union(*[x for x in terms if x & slug])


def _judge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        keep, names, unknown = [], [], []
        for i, (path, repo, text) in enumerate(zip(b.column("path").to_pylist(), b.column("repo").to_pylist(), b.column("text").to_pylist())):
            if text is None:
                continue
            v = judge(text)
            if v.own and not v.mute or v.unknown and path and _OWN_SLUG.search(path):
                continue
            segments = {wording(s) for s in v.unknown}
            slug = _slug_terms(path, repo)
            agreed = _agreed(v.titles, slug)
            about = slug | agreed
            if v.mute:
                if agreed or any(about & set(_WORD.findall(s)) for s in segments):
                    continue  # slug and title or body agree
                data = text.lstrip()[:1] in ("{", "[")  # keys of data are content, too
                body = wording(text) if data else "\n".join([*map(wording, v.titles), "", *map(wording, v.unknown)])
                unknown.append(["\1" + hashlib.blake2b(body.encode("utf-8", "surrogatepass"), digest_size=16).hexdigest()])
            else:
                unknown.append(sorted({s if not about & set(_WORD.findall(s)) else "\0slug" for s in segments}))
            keep.append(i)
            names.append(re.sub(r"\.\w+$", "", path.rsplit("/", 1)[-1]).lower() if path else None)
        rows = pa.array(keep, pa.int64())
        yield pa.RecordBatch.from_arrays(
            [b.column("doc_id").take(rows), b.column("repo").take(rows), pa.array(names, pa.string()), pa.array(unknown, pa.list_(pa.string()))], names=["doc_id", "host", "name", "unknown"]
        )


def _holders(slots: bytes):
    """(segment, host) of every text, of the segments whose slot is set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = set()
            for repo, text in zip(b.column("repo").to_pylist(), b.column("text").to_pylist()):
                t = (text or "").lstrip("\ufeff \t\r\n")
                if repo is None or not t:
                    continue
                whole = "&#" not in t  # masked at once, unless signs are written as numbers
                for p in map(_bare, _visible(_masked(t) if whole else t, [])):
                    if not p:
                        continue
                    for s in [p] if _plain_code(p) else _sentences(p):
                        w = " ".join(s.split()).strip(" .,:;!?…\"'") if whole else wording(s)
                        if slots[zlib.crc32(w.encode("utf-8", "surrogatepass")) % WORDING_SLOTS]:
                            found.add((w, repo))
            segments, hosts = zip(*found) if found else ((), ())
            yield pa.RecordBatch.from_arrays([pa.array(segments, pa.string()), pa.array(hosts, pa.string())], names=["segment", "host"])

    return run


def find_residue(documents: DataFrame, least_hosts: int = LEAST_HOSTS) -> DataFrame:
    """(doc_id) of documents that hold nothing but residue.

    The texts are judged once, and read again to count the hosts of the wordings in doubt; what is
    shuffled is these few segments. Host counts are distinct (segment, host) pairs reduced map-side, so a segment that half
    of all hosts share is no burden."""
    hosts = documents.select(F.col("repo").cast("string")).filter("repo is not null").distinct().count()
    least_hosts = max(least_hosts, math.ceil(HOST_SHARE * hosts))
    cut = spread(documents.select("doc_id", F.col("repo").cast("string").alias("repo"), F.col("path").cast("string").alias("path"), "text"))
    # Three steps read the few documents that might be residue: they are written once, not judged anew.
    seen = materialise(cut.mapInArrow(_judge, "doc_id bigint, host string, name string, unknown array<string>"))
    sure = seen.filter(F.size("unknown") == 0).select("doc_id")
    mute = F.coalesce(F.try_element_at("unknown", F.lit(1)).startswith("\1"), F.lit(False))
    doubt = seen.filter((F.size("unknown") > 0) & ~mute).withColumn("row", F.xxhash64("doc_id", "host", "unknown"))
    segments = doubt.select("doc_id", "row", "host", F.size("unknown").alias("n"), F.explode("unknown").alias("segment"))
    asked = segments.filter(~F.col("segment").startswith("\0"))
    slots = bytearray(WORDING_SLOTS)
    for (i,) in asked.select(F.pmod(F.crc32(F.col("segment").cast("binary")), F.lit(WORDING_SLOTS))).distinct().collect():  # at most WORDING_SLOTS numbers
        slots[i] = 1
    everywhere = asked.select("segment", "host").filter("host is not null")
    if any(slots):
        everywhere = everywhere.unionByName(cut.mapInArrow(_holders(bytes(slots)), "segment string, host string"))
    common = everywhere.distinct().groupBy("segment").agg(F.count(F.lit(1)).alias("hosts")).filter(F.col("hosts") >= least_hosts).select("segment")
    # Texts without evidence: whole bodies over hosts and, as copies of one file keep its name, over names.
    bodies = seen.filter(mute).select("doc_id", "host", "name", F.try_element_at("unknown", F.lit(1)).alias("segment"))
    dealt = bodies.groupBy("segment").agg(F.count_distinct("host").alias("hosts"), F.count_distinct("name").alias("names")).filter((F.col("hosts") >= least_hosts) & (F.col("names") >= least_hosts))
    alike = bodies.join(dealt.select("segment"), "segment", "left_semi").select("doc_id")
    fixed = segments.join(common, "segment", "left_semi").groupBy("doc_id", "row", "n").agg(F.count_distinct("segment").alias("known"), F.count(F.lit(1)).alias("c"))
    copies = (F.col("c") / F.col("n")).cast("int")
    return sure.unionByName(alike).unionByName(fixed.filter(F.col("known") == F.col("n")).select("doc_id", F.explode(F.array_repeat(F.lit(1), copies)).alias("_")).select("doc_id"))
