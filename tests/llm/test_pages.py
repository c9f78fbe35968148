"""Main text of made-up pages whose article is known, and of the cases that marks alone get wrong."""

import random

import pytest

from tideframe.llm import pages


def sentence(draw, n=None):
    words = [draw.choice("river stone light paper window garden letter morning harbour signal".split()) for _ in range(n or draw.randrange(12, 40))]
    return " ".join(words).capitalize() + "."


def furniture(draw):
    links = "".join(f"<li><a href='/{i}'>{sentence(draw, 3)}</a></li>" for i in range(draw.randrange(3, 9)))
    said = "".join(f"<div class='c'><b>reader{i}</b><p>{sentence(draw, 9)}</p></div>" for i in range(draw.randrange(2, 6)))
    return draw.choice([
        f"<nav><ul>{links}</ul></nav>", f"<aside><h3>More</h3><ul>{links}</ul></aside>", f"<div class='sidebar-left'><ul>{links}</ul></div>", f"<footer><p>{sentence(draw)}</p></footer>",
        f"<section class='fb-comments-v2'>{said}</section>", f"<div id='post-comments-wrapper'>{said}</div>", f"<div class='cookie-notice'><p>{sentence(draw)}</p></div>",
        f"<form><p>{sentence(draw)}</p><input name='q'></form>", f"<script>var a = '{sentence(draw)}';</script>", f"<div class='advert box'><p>{sentence(draw)}</p></div>", f"<ul>{links}</ul>",
    ])


def article(draw):
    blocks, out = [], []
    for i in range(draw.randrange(3, 9)):
        text = sentence(draw)
        if i and draw.random() < 0.2:
            text = "Look at " + sentence(draw, 8)[:-1].lower() + "."
            out.append(f"<p>Look at <a href='/x'>{text[8:-1]}</a>.</p>")
            blocks += [text, follow := sentence(draw)]
            out.append(f"<p>{follow}</p>")
            continue
        if draw.random() < 0.3:
            text = text.replace(" ", " &amp; ", 1)
        out.append(f"<p>{text.replace(' ', '  ' if draw.random() < 0.2 else ' ')}</p>")
        blocks.append(text.replace("&amp;", "&"))
    return blocks, "\n".join(out)


@pytest.mark.parametrize("seed", range(60))
def test_made_up_pages(seed):
    draw = random.Random(seed)
    blocks, body = article(draw)
    tag = draw.choice(["<article>{}</article>", "<main>{}</main>", "<div class='entry-content'>{}</div>", "<div class='post has-comments no-sidebar'>{}</div>"])
    parts = [furniture(draw) for _ in range(draw.randrange(1, 5))] + [tag.format(body)] + [furniture(draw) for _ in range(draw.randrange(1, 5))]
    page = f"<html><head><title>{sentence(draw)}</title></head><body>{''.join(parts)}</body></html>"
    assert pages.main_text(page) == "\n\n".join(blocks)


def plain_stretches(own, window=pages.WINDOW):
    """Sums of each window added up anew."""
    sums = [sum(own[max(0, i - window + 1) : i + 1]) for i in range(len(own))]
    out, i = [], 0
    while i < len(sums):
        if not sums[i]:
            i += 1
            continue
        j = i
        while j < len(sums) and sums[j]:
            j += 1
        lines = [k for k in range(i, j) if own[k]]
        out.append((lines[0], lines[-1] + 1, any(s >= pages.SURGE for s in sums[i:j])))
        i = j
    return out


@pytest.mark.parametrize("seed", range(40))
def test_surge_and_dive(seed):
    draw = random.Random(seed)
    own = [draw.choice([0, 0, 0, 0, 5, 30, 90]) for _ in range(draw.randrange(0, 60))]
    assert pages.stretches(own) == plain_stretches(own)


def test_a_reference_between_paragraphs_stays():
    one, two = "First words of it. " * 5, "Second words of it. " * 5
    page = f"<article><p>{one}</p><p>See <a>the full report on the subject of the article here</a>.</p><p>{two}</p><ul><li><a>Home and away</a></li><li><a>News of today</a></li><li><a>Sports of all kinds</a></li></ul></article>"
    assert pages.main_text(page) == f"{one.strip()}\n\nSee the full report on the subject of the article here.\n\n{two.strip()}"


def test_a_teaser_in_the_marked_part_does_not_hide_the_body():
    teaser, body = "Teaser words here. " * 22, [f"Body of the story, part {i}. " * 5 for i in range(9)]
    page = f"<body><article><p>{teaser}</p></article><div class='x'>{''.join(f'<p>{b}</p>' for b in body)}</div><div class='x2'><p>{'A short aside. ' * 8}</p></div></body>"
    got = pages.main_text(page)
    assert all(b.strip() in got for b in body) and teaser.strip() in got


@pytest.mark.parametrize("name", ["fb-comments-v2", "postComments2", "x-sidebar-y", "my-newsletter-3"])
def test_furniture_by_a_word_that_leaves_no_doubt(name):
    page = f"<body><div><p>{'Text of the story. ' * 20}</p></div><div class='{name}'><p>{'Said by a reader. ' * 10}</p></div></body>"
    assert "reader" not in pages.main_text(page)
    assert "story" in pages.main_text(page.replace(name, f"no-{name}"))
