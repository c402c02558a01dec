"""Page body in linear time and with few rules."""

import time

from lekhani.llm import pagebody


def test_many_runs_and_open_blocks_take_linear_time():
    page = "<html><head><title>The title</title></head><body><div><h1>The title</h1>" + "<a>x</a> , " * 60_000 + "<p>The end of it was in the town and for all of them on that day.</p>" + "<ul><li>z</li></ul>" * 20_000 + "</div></body></html>"
    began = time.time()
    assert pagebody.article_blocks(page)[0] == "The title"
    assert time.time() - began < 20


def test_rules_need_no_word_lists_but_for_announced_advertisements():
    page = "<html><head><title>The title</title></head><body><div><h1>The title</h1><p>By Ann Other, 3 May 2020</p><p>12/05/2020</p><p>Advertisement: buy it now in the shop of the town.</p><p>The text was long enough to be told by its stop words and its length in the end.</p></div></body></html>"
    assert "12/05/2020" not in pagebody.article_blocks(page)
    assert [x for x in pagebody.article_blocks(page) if x.startswith(("The", "Adv"))] == ["The title", "The text was long enough to be told by its stop words and its length in the end."]
