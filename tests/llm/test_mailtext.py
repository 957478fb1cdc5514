import base64
import quopri

from posegrain.llm import mailtext as M


def mail(kind, body, how=None, subject="Hi"):
    return f"From: a@b.c\nSubject: {subject}\nContent-Type: {kind}\n" + (f"Content-Transfer-Encoding: {how}\n" if how else "") + f"\n{body}"


def test_plain_and_encoded():
    text = "Grüße an alle, hier ist der Text = ganz."
    assert M.texts(mail("text/plain; charset=utf-8", text))[1] == [text]
    b = base64.encodebytes(text.encode()).decode()
    assert M.texts(mail("text/plain; charset=utf-8", b, "base64"))[1] == [text]
    assert M.texts(mail("text/plain; charset=utf-8", b[:-4], "base64"))[1][0][:20] == text[:20]
    q = quopri.encodestring(text.encode()).decode()
    assert M.texts(mail("text/plain; charset=utf-8", q, "quoted-printable"))[1][0].strip() == text


def test_html_and_parts():
    assert M.words(M.texts(mail("text/html", "<html><style>p {}</style><p>one&nbsp;<b>two</b><br>thr<i>ee</i></p></html>"))[1][0]) == ["one", "two", "three"]
    parts = f"--X\nContent-Type: text/plain\n\nfirst\n--X\nContent-Type: application/octet-stream\nContent-Transfer-Encoding: base64\n\n{base64.encodebytes(b'the text of the second part, attached').decode()}\n--X\nContent-Type: image/jpeg\nContent-Transfer-Encoding: base64\n\n{base64.encodebytes(bytes(range(256)) * 4).decode()}\n--X--\n"
    assert M.texts(mail('multipart/mixed; boundary="X"', parts))[1] == ["first", "the text of the second part, attached"]
    cut = parts[: parts.index("the") if "the" in parts else 60]
    assert M.texts(mail('multipart/mixed; boundary="X"', cut))[1][0] == "first"


def test_odd_mails():
    assert M.texts("") == ("", [""]) and M.texts("no headers at all") == ("", ["no headers at all"])
    assert M.texts("Subject: only\nFrom: x")[0] == "only"
    assert M.texts(mail("text/plain", "x", subject="=?utf-8?B?R3LDvMOfZQ==?="))[0] == "Grüße"
    assert M.texts(mail("multipart/mixed; boundary=Y", "no parts"))[1] == []
    assert len(M.texts(mail("text/plain", "word " * 200_000))[1][0]) == 1_000_000


def test_words_without_quoting():
    assert M.words("> one\nKa> two\n| > three, FOUR") == ["one", "two", "three", "four"]
    body = "Hello Ann,\n\nThe gimbal 12 is late.\n\n-- \nAnn Bee\n12 Lane\n\nOn 3 May 2025, Bob Cee wrote:\n> Yes."
    assert M.prose_words("[list] Re: gimbal", [body]) == ["re", "gimbal", "the", "gimbal", "is", "late", "yes"]
