"""Small pages in the default site's markup."""

from hunian.operators.pages import Site

BASE = "https://site.test"
SITE = Site(BASE)


def card(title, link, extra=""):
    heading = f"<h2>{title}</h2>" if title is not None else ""
    anchor = f'<a class="x" href="{link}">{heading}</a>' if link is not None else heading
    return f'<div class="grid ui-organism-intersection__element"><div>{extra}</div>{anchor}</div>'


def search(*cards):
    return (
        "<html><!-- " + card("Hidden", "/properti/hidden") + " --><body>" + "".join(cards)
        + '<footer><a href="/properti/foot"><h2>Footer</h2></a></footer></body></html>'
    )


def detail(title, price="Rp 1,5 Miliar", location="Cibeunying, Bandung", update="Diperbarui 2024-05-01 oleh Sari",
           pairs=()):
    labelled = "".join(f"<div><p>{a}</p><p>{b}</p></div>" for a, b in pairs)
    loc = f'<p class="text-xs text-gray-500 mb-2">{location}</p>' if location is not None else ""
    upd = f'<p class="text-3xs text-gray-400 mb-4">{update}</p>' if update is not None else ""
    return (
        f'<html><script>var s = "<h1>script</h1>";</script><h1> {title} </h1>'
        f'<div>{loc}</div><div>{upd}</div><span class="font-bold text-primary">{price}</span>{labelled}</html>'
    )
