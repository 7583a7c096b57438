"""The choice of regions against a plain version that follows its definitions, and pages on which text was once lost."""

import random

import numpy as np

from gridlode.llm import html_text
from gridlode.llm.html_text import Line, main_text


def plain_content(lines, inside):
    ratios = [0.0 if x.barred else len(x.text) / max(1, x.tags) * (2.0 if inside[x.container] else 1.0) for x in lines]
    weights = [np.exp(-0.5 * k * k) for k in (-2, -1, 0, 1, 2)]
    at = lambda k: ratios[min(max(k, 0), len(lines) - 1)]
    smooth = [sum(w * at(n + k) for w, k in zip(weights, (-2, -1, 0, 1, 2))) / sum(weights) for n in range(len(lines))]
    return [n for n, x in enumerate(lines) if not x.barred and x.linked <= 0.5 * len(x.text) and smooth[n] >= np.std(smooth) - 1e-9]


def plain_regions(lines, parents, roots):
    def chain(c):
        return [c, *(chain(parents[c]) if c else [])]

    inside = [any(roots[a] for a in chain(c)) for c in range(len(parents))]
    free = [n for n, x in enumerate(lines) if not x.barred]
    content = plain_content(lines, inside)
    if not content:
        return free
    members = lambda c: [n for n in free if c in chain(lines[n].container)]
    outermost = lambda c: [a for a in chain(c) if roots[a]][-1]

    def region(c):
        return outermost(c) if inside[c] else next((a for a in chain(c) if a and len(members(a)) > 1), 0)

    picked = {region(lines[n].container) for n in content} | {outermost(c) for c in range(1, len(parents)) if inside[c]}

    def holds(c):  # itself selected or something in it
        return chosen(c) or any(holds(k) for k in range(1, len(parents)) if parents[k] == c)

    def chosen(c):
        return c in picked or sum(holds(k) for k in range(1, len(parents)) if parents[k] == c) > 1

    selected = {c for c in range(1, len(parents)) if chosen(c)}
    out = {n for n in free if selected & set(chain(lines[n].container))}
    grown = set()
    for n in out:
        if inside[lines[n].container]:
            continue
        for step in (-1, 1):
            k = n + step
            while 0 <= k < len(lines) and k not in out and not lines[k].barred and lines[k].linked <= 0.5 * len(lines[k].text):
                if not set(chain(lines[k].container)) & set(chain(lines[n].container)[1:]) - {0}:
                    break
                grown.add(k)
                k += step
    out |= grown
    if 0 in picked:
        own = [n for n in free if region(lines[n].container) == 0]
        hits = [k for k, n in enumerate(own) if n in content]
        first, last = hits[0], hits[-1]
        while first and lines[own[first - 1]].paragraph and own[first - 1] == own[first] - 1:
            first -= 1
        while last + 1 < len(own) and lines[own[last + 1]].paragraph and own[last + 1] == own[last] + 1:
            last += 1
        out |= set(own[first : last + 1])
    return sorted(out)


def test_regions_equal_a_plain_version():
    rng = random.Random(8)
    for _ in range(1500):
        parents = [0] + [rng.randrange(0, c) for c in range(1, rng.randrange(1, 9))]
        roots = [False] + [rng.random() < 0.15 for _ in parents[1:]]
        lines = []
        for _ in range(rng.randrange(1, 14)):
            text = "x" * rng.choice([3, 10, 60, 200])
            lines.append(Line(text, rng.choice([0, 1, 2, 9]), rng.random() < 0.2, rng.random() < 0.5, rng.randrange(len(parents)), rng.choice([0, 0, 0, len(text)])))
        assert html_text.regions(lines, parents, roots) == plain_regions(lines, parents, roots)


P = "<p>" + "a paragraph that goes on and on with much text in it " * 4 + "</p>"
TEXT = ("a paragraph that goes on and on with much text in it " * 4).strip()


def test_short_articles_leads_and_ends_stay():
    assert main_text(f"<article>{P * 3}</article><article><p>short one</p></article>").split("\n\n") == [TEXT] * 3 + ["short one"]
    for lead, end in (("<p>Lead.</p><p>More.</p>", "<p>End.</p><p>Bye.</p>"), ("Lead.<br>More.", "End. Bye.")):
        page = f"<nav><a href=x>Home</a></nav><div id=w><div class=content><div class=lead>{lead}</div><div class=body>{P * 6}</div><div class=end>{end}</div></div></div><footer>foot</footer>"
        got = main_text(page)
        assert got.startswith("Lead.") and got.endswith("Bye.") and got.count(TEXT) == 6 and "Home" not in got and "foot" not in got


def test_links_beside_a_region_stay_out_and_links_in_it_stay():
    page = f"<div id=w><div class=x1><a href=1>Home</a> <a href=2>About</a></div><div class=post>{P * 3}<p><a href=4>a source</a></p>{P}</div><div class=y><a href=3>Next page</a></div></div>"
    assert main_text(page).split("\n\n") == [TEXT] * 3 + ["a source", TEXT]


def test_a_menu_that_is_never_closed_bars_no_paragraphs():
    assert main_text(f"<article><nav>Home About{P * 2}</article>").split("\n\n") == [TEXT] * 2
    assert main_text(f"<body><nav><ul><li>a<li>b</ul><h1>Title</h1>{P}").split("\n\n") == ["Title", TEXT]
    assert main_text(f"<div class=sidebar>Ad{P * 2}").split("\n\n") == [TEXT] * 2
    assert main_text(f"<article><nav>Home<p>inside</p></nav>{P}</article>") == TEXT
    assert main_text(f"<div><form><p>send</p></form></div><article>{P}</article>") == TEXT
