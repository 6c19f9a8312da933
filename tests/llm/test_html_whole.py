"""No readable text but what a host leaves out is lost: odd pages, lists of sources, mains with more than an article, pages without <article>."""

import random

from marketlake.llm import host_paths


def words(n, w):
    return " ".join(f"{w}{i}" for i in range(n))


def page(inner, head="<nav><ul><li><a href=x>Home</a></li></ul></nav>", foot="<footer>foot</footer>"):
    return f"<html><body>{head}<div id=wrap>{inner}</div>{foot}</body></html>"


def texts(spark, sources, host="a.example"):
    df = spark.createDataFrame([(i, f"http://{host}/{i}", h) for i, h in enumerate(sources)], "page_id long, url string, html string")
    return [r.text for r in host_paths.main_text(df).orderBy("page_id").collect()]


ORDINARY = [page(f"<div class=text><p>{words(40, f'a{i}x')}</p></div>") for i in range(20)]


def test_a_part_of_one_page_only_is_kept(spark):
    odd = page(f"<div class=text><p>{words(20, 'own')}</p></div><div class=continued><p>{words(200, 'more')}</p></div>")
    got = texts(spark, [*ORDINARY, odd])
    assert got[20] == f"{words(20, 'own')} {words(200, 'more')}" and got[3] == words(40, "a3x")


def test_a_part_that_pages_share_follows_the_host(spark):
    """Unnamed remarks under some articles: most pages show where the article ends."""
    remarks = [page(f"<div class=text><p>{words(60, f'b{i}x')}</p></div><div class=zz><p>{words(9, f'r{i}x')}</p></div>") for i in range(3)]
    got = texts(spark, [*ORDINARY, *remarks])
    assert got[20:] == [words(60, f"b{i}x") for i in range(3)]


def test_sources_of_an_article_stay_and_menus_go(spark):
    cited = "".join(f"<li><a href=s{i}>A cited work of some length, number {i}, by its author</a></li>" for i in range(5))
    menu = "".join(f"<li><a href=m{i}>Topic {i}</a></li>" for i in range(8))
    got = texts(spark, [page(f"<div class=text><p>{words(50, 'w')}</p><ul>{cited}</ul><ul>{menu}</ul></div>")])[0]
    assert got == words(50, "w") + "".join(f" A cited work of some length, number {i}, by its author" for i in range(5))


def test_a_main_is_more_than_its_article(spark):
    inner = f"<main><p>{words(8, 'lead')}</p><article><p>{words(60, 'body')}</p></article><p>{words(6, 'close')}</p></main><aside>beside</aside>"
    assert texts(spark, [page(inner)])[0] == f"{words(8, 'lead')} {words(60, 'body')} {words(6, 'close')}"


def test_pages_without_article_by_brute_force(spark):
    """Pages of random nested containers, some of them junk by tag or name: all other text comes, in order."""
    rng = random.Random(11)
    n = [0]

    def part(depth, junk):
        out, kept = [], []
        for _ in range(rng.randint(1, 3)):
            kind = rng.random()
            if kind < 0.5 or depth > 3:
                n[0] += 1
                text = words(rng.randint(12, 30), f"p{n[0]}x")
                out.append(f"<p>{text}</p>")
                kept += [] if junk else [text]
            else:
                bad = kind > 0.85
                tag = rng.choice(["nav", "footer", "aside", 'div class="sidebar"', 'div id="comments"', 'section class="related"']) if bad else rng.choice(["div", "section", 'div class="part"', 'div class="col"'])
                inner, more = part(depth + 1, junk or bad)
                out.append(f"<{tag}>{inner}</{tag.split()[0]}>")
                kept += more
        return "".join(out), kept

    sources, want = [], []
    for _ in range(60):
        inner, kept = part(0, False)
        sources.append(f"<html><head><title>t</title></head><body>{inner}</body></html>")
        want.append(" ".join(kept))
    # hosts of a page each: nothing to go by but the page; then one host for all
    df = spark.createDataFrame([(i, f"http://h{i}.example/", h) for i, h in enumerate(sources) if want[i]], "page_id long, url string, html string")
    for r in host_paths.main_text(df).collect():
        assert r.text == want[r.page_id], sources[r.page_id]
