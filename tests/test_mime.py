import pytest
from gridloom.errors import LenientError, ParseError
from gridloom.limits import Budgets
from gridloom.queries import ROOT_CASES
from gridloom.sources import mime


@pytest.mark.parametrize("name", ROOT_CASES)
def test_root_cases(name):
    content, code, notes = ROOT_CASES[name]
    if code:
        with pytest.raises(ParseError) as found:
            mime.strict_document(content.encode())
        assert found.value.code == code
    else:
        assert ",".join(mime.strict_document(content.encode()).notes) == notes


def test_parameter_names_ignore_quotes_and_comments():
    assert mime.parameter_names('a/b; boundary="x;type=y"; (c; start=1 (nested)) type=z') == ["boundary", "type"]


@pytest.mark.parametrize(("value", "normal"), [(None, None), (" <a@b> ", "a@b"), ("<>", None), ("x", "x")])
def test_content_id(value, normal):
    assert mime.normal_id(value) == normal


def nested(depth: int) -> bytes:
    head = "".join(f"Content-Type: multipart/related; boundary=b{i}\n\n--b{i}\n" for i in range(depth))
    return ("MIME-Version: 1.0\n" + head + "Content-Type: text/html\n\n<p>\n").encode()


def test_deep_nesting_is_a_code():
    with pytest.raises(ParseError) as found:
        mime.strict_document(nested(200))
    assert found.value.code in ("mime_nesting_too_deep", "invalid_mime")


def test_budgets_and_charsets():
    for budgets, code in ((Budgets(source_bytes=5), "source_too_large"), (Budgets(html_chars=3), "html_too_large")):
        with pytest.raises(ParseError) as found:
            mime.strict_document(b"MIME-Version: 1.0\nContent-Type: text/html\n\n<table></table>", budgets)
        assert found.value.code == code
    with pytest.raises(ParseError) as found:
        mime.strict_document(b"MIME-Version: 1.0\nContent-Type: text/html; charset=utf-8\nContent-Transfer-Encoding: 8bit\n\n\xff\xfe\xfa")
    assert found.value.code == "html_decode_failed"
    with pytest.raises(ParseError):
        Budgets(rows=0)


def test_lenient_takes_the_largest_page():
    part = "--b\nContent-Type: text/html\n\n{}\n"
    data = "MIME-Version: 1.0\nContent-Type: multipart/related; boundary=b\n\n" + part.format("<p>1</p>") + part.format("<p>three</p>") + part.format("<p>other</p>") + "--b--\n"
    assert mime.lenient_html(data.encode()) == b"<p>three</p>"
    assert mime.lenient_html(b"<html><table></table></html>").startswith(b"<html>")
    for bad in (b"", b"  ", b"plain text"):
        with pytest.raises(LenientError):
            mime.lenient_html(bad)
