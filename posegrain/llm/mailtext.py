"""What a raw mail says: its subject and every text in it, decoded from whatever it was wrapped in."""

from __future__ import annotations

import binascii
import html
import quopri
import re

HEADER = re.compile(r"^([A-Za-z][A-Za-z0-9-]*):[ \t]*(.*(?:\n[ \t]+.*)*)", re.M)
BOUNDARY = re.compile(r"boundary\s*=\s*(?:\"([^\"\n]+)\"|([^\s;]+))", re.I)
CHARSET = re.compile(r"charset\s*=\s*\"?([\w.:-]+)", re.I)
ENCODED_WORD = re.compile(r"=\?([\w.-]+)\?([bBqQ])\?([^?]*)\?=")
NOT_BASE64 = re.compile(r"[^A-Za-z0-9+/]+")
# Tags that separate words; others, as <b>, can stand within a word.
BLOCK_TAG = re.compile(r"<\s*/?\s*(?:br|p|div|tr|td|th|li|ul|ol|table|h[1-6]|hr|body|html|head|blockquote|pre)\b[^>]*>", re.I)
ANY_TAG = re.compile(r"<(?:!--.*?-->|/?[A-Za-z!][^>]*>)", re.S)
HIDDEN = re.compile(r"<(script|style)\b.*?</\1\s*>", re.S | re.I)
INVISIBLE = re.compile("[­​-‏⁠﻿]")


def _to_text(data: bytes, charset: str | None) -> str | None:
    """Decoded text, or None for binary data."""
    for name in (charset or "utf-8", "utf-8"):
        try:
            text = data.decode(name)
            break
        except UnicodeDecodeError as cut:
            # Text that is cut short may end within a character.
            if name.lower().replace("-", "") == "utf8" and cut.start >= len(data) - 3 > 0:
                text = data[: cut.start].decode(name)
                break
        except LookupError:
            continue
    else:
        text = data.decode("latin-1")
    head = text[:400]
    odd = sum(not (c.isprintable() or c in "\t\r\n\f") or "\u0080" <= c < " " for c in head)
    if odd * 20 > len(head):
        return None
    if charset is None and len(head) >= 20 and sum(c.isalnum() or c in " .,;:-\n" for c in head) * 10 < len(head) * 7:
        return None
    return text


def unbase64(text: str) -> bytes:
    """As much as can be decoded; other characters and a cut end are passed over."""
    chars = NOT_BASE64.sub("", text)
    chars = chars[: len(chars) - (len(chars) % 4 == 1)]
    return binascii.a2b_base64(chars + "=" * (-len(chars) % 4))


def unquote(text: str) -> bytes:
    return quopri.decodestring(text.encode("utf-8", "surrogateescape"))


def unmark(text: str) -> str:
    """HTML without its markup."""
    text = HIDDEN.sub(" ", text)
    return html.unescape(ANY_TAG.sub("", BLOCK_TAG.sub("\n", text)))


def decode_words(value: str) -> str:
    def one(m: re.Match) -> str:
        data = unbase64(m[3]) if m[2] in "bB" else unquote(m[3].replace("_", " "))
        return _to_text(data, m[1]) or ""

    return ENCODED_WORD.sub(one, value) if "=?" in value else value


def _headers(head: str) -> dict[str, str]:
    return {m[1].lower(): m[2] for m in HEADER.finditer(head)}


def _entity(head: dict[str, str], body: str, out: list[str], depth: int) -> None:
    kind = head.get("content-type", "text/plain")
    low = kind[:64].lower()
    if low.startswith("multipart/") and depth < 8:
        m = BOUNDARY.search(kind)
        if m:
            for part in body.split("\n--" + (m[1] or m[2]))[0 if body.startswith("--") else 1 :] if not body.startswith("--" + (m[1] or m[2])) else ("\n" + body).split("\n--" + (m[1] or m[2]))[1:]:
                if part[:2] == "--":
                    continue
                top, found, rest = part.lstrip("\r\n").partition("\n\n")
                if found:
                    _entity(_headers(top), rest, out, depth + 1)
                elif top:
                    _entity({}, top, out, depth + 1)
            return
    if low.startswith("message/rfc822") and depth < 8:
        top, _, rest = body.partition("\n\n")
        out.append(decode_words(_headers(top).get("subject", "")))
        _entity(_headers(top), rest, out, depth + 1)
        return
    how = head.get("content-transfer-encoding", "").strip().lower()
    charset = CHARSET.search(kind)
    name = charset[1] if charset else None
    if how == "base64":
        body = _to_text(unbase64(body), name)
        if body is None:
            return
    elif how == "quoted-printable" or (not how and "=\n" in body and "=20" in body):
        body = _to_text(unquote(body), name or "utf-8")
        if body is None:
            return
    if low.startswith("text/html") or "<html" in body[:400].lower():
        body = unmark(body)
    out.append(body)


def texts(mail: str) -> tuple[str, list[str]]:
    """(subject, texts) of a raw mail: body parts and attachments that are text, each decoded.

    Mails without headers or blank line count as text as a whole. Binary attachments hold no text.
    """
    mail = mail.replace("\r\n", "\n")
    top, found, body = mail.partition("\n\n")
    head = _headers(top) if ":" in top else {}
    if not head:
        return "", [mail]
    out: list[str] = []
    if found:
        _entity(head, body, out, 0)
    return decode_words(head.get("subject", "")), [INVISIBLE.sub("", t) for t in out]


#: Marks of quoting at the start of lines: ``>``, ``|`` and initials as in ``Ka>``, also several of them.
QUOTE_MARK = re.compile(r"^[ \t]*(?:(?:[^\W\d_]{1,3}>|[>|])[ \t]?)+", re.M)
WORD = re.compile(r"[^\W_]+")


def words(text: str) -> list[str]:
    """Lower-case words without marks of quoting; punctuation and layout do not matter."""
    return WORD.findall(QUOTE_MARK.sub("", text).lower())


# What in a mail is about people and delivery and not prose: header lines of quoted mails, attributions,
# addresses, greetings, signatures up to the next blank line, and lines of capitalised names only.
NOT_PROSE = re.compile(
    r"^[^\n]*@[^\n]*$"
    r"|^(?:From|To|Cc|Sent|Date|Von|An|Gesendet|De|Para|Enviado|Message-ID|References|In-Reply-To|Received):[^\n]*$"
    r"|^[^\n]{0,90}\b(?:wrote|schrieb|escribió)\b[^\n]{0,60}:?[ \t]*$"
    r"|^(?:Hello|Hallo|Hola|Hi|Dear|Liebe[r]?|Querid[oa])\b[^\n]{0,30},[ \t]*$"
    r"|^(?:--|__)[ \t]*\n(?:[^\n]*\S[^\n]*(?:\n|\Z)){1,6}"
    r"|^[ \t]*(?:[A-ZÄÖÜ][a-zäöüß]+[ \t]*){1,3}$",
    re.M,
)
#: Names of lists in subject lines, also of quoted mails.
LIST_TAG = re.compile(r"\[[^\]\s]*\]")
LETTERS = re.compile(r"[^\W\d_]+")


def prose_words(subject: str, parts: list[str]) -> list[str]:
    """Lower-case words of the subject line and of the prose in the texts; no numbers."""
    body = NOT_PROSE.sub(" ", QUOTE_MARK.sub("", "\n\n".join(parts)))
    return LETTERS.findall(LIST_TAG.sub(" ", f"{subject} {body}").lower())
