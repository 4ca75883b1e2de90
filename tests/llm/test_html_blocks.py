"""Where tags end, whatever their attributes hold."""

import time

import pytest

from gridloom.llm.html_blocks import leaf_blocks


def texts(page):
    return [b.text for b in leaf_blocks(page)]


@pytest.mark.parametrize("size", [100, 9_000, 1_000_000])
@pytest.mark.parametrize("quote", ['"', "'"])
def test_long_quoted_values_with_brackets(size, quote):
    other = "'" if quote == '"' else '"'
    value = ("a > b <p>no</p> <b " + other) * (size // 20) + ">"
    page = f"<div data-x={quote}{value}{quote} class=nav>one</div><iframe srcdoc = {quote}{value}{quote}>no</iframe><p>two</p>"
    blocks = leaf_blocks(page)
    assert [b.text for b in blocks] == ["one", "two"]
    assert blocks[0].signs != blocks[1].signs


def test_quotes_that_hold_nothing():
    assert texts('<p title="never closed>one</p><p>two</p>') == ["one", "two"]
    assert texts("<p title=Bob's>one</p>" + "<p>text</p>" * 2000 + "<p>it's</p>") == ["one", *["text"] * 2000, "it's"]
    assert texts('<p title="a>b" class=x="y>one</p><p>"two"</p>') == ["one", '"two"']
    assert texts("<p>one</p><a title='x") == ["one"]


@pytest.mark.parametrize("part", ['<a x=">" ', "<a x='>' y=\">\" ", '<a x=">', "<a x='\">", "<a x=", '<a x="', "<a ", "<a = = "])
def test_hostile_pages_take_no_longer_than_their_length(part):
    started = time.process_time()
    leaf_blocks(part * (600_000 // len(part)))
    assert time.process_time() - started < 10


@pytest.mark.parametrize("open_elements", [0, 10, 11, 10_000])
def test_a_paragraph_ends_the_one_before_however_much_is_open_in_it(open_elements):
    first, second = leaf_blocks('<p class="ad">' + "<b>" * open_elements + "one<p>two")
    assert (first.text, second.text) == ("one", "two") and first.signs != second.signs and second.parent != first.parent


@pytest.mark.parametrize("page", ["<b>" * 130_000 + "</i>" * 130_000 + "x", ("<b>x<div>y" * 90_000), "<b><i>" * 80_000 + "x</b>" * 80_000])
def test_many_open_elements_take_no_longer_than_the_page(page):
    started = time.process_time()
    assert leaf_blocks(page)
    assert time.process_time() - started < 6
