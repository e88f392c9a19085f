from __future__ import annotations

import pytest

from starquill.llm import html_text


@pytest.mark.parametrize("style,hidden", [
    ("display:none", True), (" DISPLAY : None ; color:red", True), ("visibility:hidden", True),
    ("visibility:collapse", True), ("backface-visibility:hidden", False),
    ("-webkit-backface-visibility: hidden", False), ("display:none;display:block", False),
    ("display:block;display:none", True), ("display:none!important;display:block", True),
    ("display: block ! important; display:none", False), ("/* display:none */color:red", False),
    ("display:", False), ("", False), ("x-display:none", False), (";;:none;display", False)])
def test_styles(style, hidden):
    assert html_text._hides(style) is hidden


def test_text_stays_beside_a_look_alike():
    page = '<div style="backface-visibility:hidden">seen</div><p style="display:none">not</p>after'
    assert html_text.visible_text(page).split() == ["seen", "after"]


@pytest.mark.parametrize("page,want", [
    ('<div style="visibility:hidden">a<p style="visibility:visible">seen</p>b</div>c', ["seen", "c"]),
    ('<div style="visibility:hidden">a<p style="visibility:inherit">b</p></div>c', ["c"]),
    ('<div style="visibility:hidden"><p style="visibility:initial">x</p><p style="visibility:odd">y</p></div>', ["x"]),
    ('<div style="display:none">a<p style="display:block;visibility:visible">b</p></div>c', ["c"]),
    ('<div style="visibility:hidden;visibility:sometimes">a</div>c', ["c"]),
    ('<pre style="visibility:hidden">a\n\n<b style="visibility:visible">b  c</b></pre>d', ["b", "c", "d"]),
    ('<ul style="visibility:hidden"><li>a<li style="visibility:visible">b</ul>', ["-", "b"]),
    ('<table style="visibility:collapse"><tr><td>a<td style="visibility:visible">b</table>c', ["b", "c"])])
def test_visibility_is_inherited(page, want):
    assert html_text.visible_text(page).split() == want


@pytest.mark.parametrize("start,want", [
    ("200000000", "200000000."), ("-200000000", "-200000000."), ("2147483647", "2147483647."),
    ("2147483648", "1."), ("9" * 5000, "1."), (" +7x", "7."), ("x", "1."), ("", "1.")])
def test_list_numbers_are_whole(start, want):
    assert html_text.visible_text(f'<ol start="{start}"><li>a</ol>') == f"{want} a"
    assert html_text.visible_text(f'<ol><li value="{start}">a</ol>') == f"{want} a"


def test_a_deep_page_of_invisible_elements():
    page = '<div style="visibility:hidden">a' * 20000 + '<i style="visibility:visible">b</i>'
    assert html_text.visible_text(page).split() == ["b"]
