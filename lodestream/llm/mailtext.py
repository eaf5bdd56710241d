"""The parts of a mail body, line by line: quoted history, introductions, signatures.

Pure functions on one body and the body it answers; see newtext for the operator.
"""

from __future__ import annotations

import re
from functools import lru_cache

_DAY = r"(?:\d{1,2}[./ ]|\w{3,9},? )"
#: Lines that introduce quoted text, by mail program (fixed values).
_INTRO = re.compile(
    r"^(?:"
    r"(?:on|am|le|el|op|il|den|em)\b.{4,160}(?:wrote|schrieb|a écrit|escribió|schreef|ha scritto|skrev|escreveu)\b[^.!?]{0,80}:"
    r"|[^:]{3,80} wrote on \d{1,2}[/.]\d{1,2}[/.]\d{2,4}(?:,? \d{1,2}:\d{2})?:"
    r"|\d{1,2}\.? \w+\.? \d{4},? (?:at )?\d{1,2}:\d{2}(?:[ap]m)?,? \"?.{2,60}\"? <?\S+@\S+>?:"
    r"|[^<>:]{2,60} <\S+@\S+> (?:wrote|schrieb|a écrit) ?:"
    r")$",
    re.I,
)
_INTRO_BEGINS = re.compile(rf"^(?:on|am|le|el)\b {_DAY}.{{4,60}}\d{{1,2}}:\d{{2}},?$", re.I)
_INTRO_ENDS = re.compile(r"^[^:]{2,80}(?:<\S+@\S+>)? (?:wrote|schrieb|a écrit|escribió) ?:$", re.I)
_RULE = re.compile(
    r"^(?:-{2,} ?(?:original message|original appointment|forwarded message|ursprüngliche nachricht|weitergeleitete nachricht|message d'origine|message transféré|mensaje original|mensaje reenviado) ?-{2,}"
    r"|begin forwarded message:|anfang der weitergeleiteten nachricht:|début du message réexpédié ?:)$",
    re.I,
)
_KEY = re.compile(r"^\*?(from|sent|date|to|cc|bcc|subject|reply-to|importance|von|gesendet|datum|an|betreff|de|envoyé|à|objet|para|asunto|enviado|fecha)\s?:\*?(?:\s|$)", re.I)
_FROM = re.compile(r"^\*?(?:from|von|de)\s?:\*?\s+\S", re.I)

#: Closing formulas (fixed values); nothing else may stand on the line.
_CLOSING = re.compile(
    r"^(?:(?:with |many |kind |warm |best |kindest |warmest )*(?:regards|rgds|wishes)|thanks|thank you|thx|thanks ?(?:and|&|n|,) ?(?:kind |warm |best )?(?:regards|rgds)|br|kr|cheers|sincerely|yours (?:sincerely|faithfully|truly)|best"
    r"|(?:mit )?(?:freundlichen?|besten?|viele[n]?) gr(?:ü|ue)(?:ß|ss)en?|mfg|vg|cordialement|bien à vous|saludos|atentamente|un saludo|cordiali saluti)\s*[,.!]?$",
    re.I,
)
_DELIMITER = re.compile(r"^(?:--|—|_{5,}|={5,}|\*{3,}|-{5,}|~{3,})$")
_SIGNED = re.compile(r"^(?:~ .{2,40} ~|\*[^*]{2,40}\*|- ?[A-Z][a-z]+)$")
_CONTACT = re.compile(r"(?:\+?\d[\d ()/-]{7,}\d)|\b(?:www\.|https?://)\S+|\b\S+@\S+\.\w+|^(?:m|t|p|w|e|mob|tel|desk|phone|fax|web|cell)\s?[:.]?\s*\+?[\w.]", re.I)
_PHONE = re.compile(r"\+\d[\d ()-]{7,}\d")
_SITE = re.compile(r"^(?:w|web|www)\s?[:.]\s*\S+$", re.I)
#: Beginnings of notes, banners and device footers (fixed values).
_LEGAL = re.compile(
    r"^(?:important notice$|confidentiality notice\b|registered office\b|caution: (?:this|external)|\[[^\]]*(?:internal|external|confidential|public)\]$"
    r"|sent from (?:my|mobile|outlook|mail)|get outlook for|von meinem \w+ gesendet|envoyé de mon|enviado desde mi|you are receiving this|please (?:think|consider) (?:before|the environment))",
    re.I,
)
#: Words of legal notes; two different ones make a line one (fixed values).
_LAW = re.compile(
    r"\b(disclaimers?|confidential\w*|privileged|addressees?|recipients?|liab\w+|unauthori[sz]ed|disclos\w+|copying|dissemination|permitted|prohibited|virus\w*|malware|warrant\w+|privacy"
    r"|personal data|transmission|by mistake)\b",
    re.I,
)
_GREETING = re.compile(r"^(?:hi|hello|hey|dear|greetings|good (?:morning|afternoon|evening|day)|team|guten (?:tag|morgen)|hallo|sehr geehrte|bonjour|buenos días|hola|all|folks)\b.{0,40}[,!:\s-]*$", re.I)
#: "> 9 years needed": a comparison, no quote
_COMPARES = re.compile(r"^>=? ?\d+(?:[.,]\d+)? ?(?:%|\+|yrs?\b|years?\b|lpa\b|k\b|lakhs?\b|months?\b|days?\b|\w+ )", re.I)
_MARK = re.compile(r"^(?:>|\|) ?")


def plain(line: str) -> str:
    """A line's text without quote marks before it, for comparison across mails."""
    while m := _MARK.match(line.strip()):
        line = line.strip()[m.end() :]
    return " ".join(line.split()).rstrip("| ").lower()


def one_less(line: str) -> str:
    """A quoted line without its outer quote mark."""
    s = line.lstrip()
    m = _MARK.match(s)
    return s[m.end() :] if m else s


@lru_cache(maxsize=200_000)
def kind(line: str) -> str:
    """What a line is by its form alone: blank, closing, delimiter, signed, legal, contact,
    greeting or text."""
    s = line.strip()
    if not s:
        return "blank"
    if len(s) < 60 and _CLOSING.match(s):
        return "closing"
    marked = s[0] in "-—_=*~"
    if marked and _DELIMITER.match(s):
        return "delimiter"
    if _LEGAL.match(s) or len({x.lower() for x in _LAW.findall(s)}) > 1:
        return "legal"
    if marked and _SIGNED.match(s):
        return "signed"
    if len(s) < 90 and _PHONE.search(s) or _SITE.match(s):
        return "contact"
    if len(s) < 80 and _GREETING.match(s):
        return "greeting"
    return "text"


def intro_at(lines: list[str], i: int) -> int:
    """If lines i.. introduce quoted text, the line after the introduction, else i."""
    s = lines[i].strip()
    if not s or s[-1] not in ":,-_" and not _FROM.match(s):
        return i  # no introduction ends so, but one that begins with the writer
    if s[-1] == ":" and _INTRO.match(s):
        return i + 1
    if i + 1 < len(lines) and _INTRO_BEGINS.match(s) and _INTRO_ENDS.match(lines[i + 1].strip()):
        return i + 2
    j = i
    ruled = False
    if _RULE.match(s) or len(s) >= 20 and not s.strip("_"):
        ruled = True
        j = i + 1
        while j < len(lines) and not lines[j].strip():
            j += 1
    if j < len(lines) and _FROM.match(lines[j].strip()):
        k = j + 1
        keys = 1
        while k < len(lines) and k < j + 8 and _KEY.match(lines[k].strip()):
            keys += 1
            k += 1
        if keys >= 2:
            return k
    if ruled and _RULE.match(s):
        return j
    return i
