"""Names of whole pages, states and wrappers do not speak against the text that they hold."""

import pytest

from ridewright.llm import extraction

LONG = "Seven herons watch the quiet river below the old stone bridge while the water rises. " * 6
LONG = LONG.strip()
AD = "Buy now, cheap! Everything must go before the end of this long week in the new shop around the corner."
BODY = '{article}<div class="sidebar"><p>' + AD + "</p></div>"
ARTICLE = "<article{names}><h1>River</h1><p>" + LONG + "</p></article>"


@pytest.mark.parametrize("body", ["", ' class="has-sidebar"', ' class="menu-closed"', ' class="sidebar nav"', ' id=comments class="no-js modal-open"'])
@pytest.mark.parametrize("names", ["", ' class="post tag-legal"', ' class="comments share"'])
@pytest.mark.parametrize("wrapper", ["{}", '<div id="page" class="no-comments">{}</div>', '<div class="sidebar-left layout">{}</div>',
                                     '<div class="nav-layout"><div class="with-widget sidebar-layout">{}</div></div>'])
def test_the_article_stays_and_the_sidebar_goes(body, names, wrapper):
    page = f"<html{body}><body{body}>" + wrapper.format(BODY.format(article=ARTICLE.format(names=names))) + "</body></html>"
    assert extraction.main_text(page) == "River\n" + LONG


def test_a_wrapper_without_landmarks_holds_the_text():
    assert extraction.main_text(f'<body><div class="widget"><p>{LONG}</p><p>{LONG}</p></div></body>') == f"{LONG}\n{LONG}"


@pytest.mark.parametrize("inner", ["<p>{}</p>", "<article><p>{}</p></article>"])
@pytest.mark.parametrize("post", [ARTICLE.format(names=""), f"<h1>River</h1><p>{LONG}</p>", f"<div><p>{LONG}</p></div>"])
def test_comments_longer_than_the_article_go(post, inner):
    comments = "".join(inner.format(LONG.replace("herons", f"readers{i}")) for i in range(20))
    text = extraction.main_text(f'<body class="has-sidebar">{post}<section id="comments">{comments}</section></body>')
    assert "readers" not in text and LONG in text
