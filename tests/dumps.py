"""Small page dumps written by hand."""

from __future__ import annotations

# The names of the elements, here and below.
HEADER = '<mediawiki xml:lang="en">\n'
FOOTER = "</mediawiki>\n"


def page(
    doc_id: str | None,
    text: str | None,
    title: str = "Some Title",
    contributor: str | None = "<username>Ann</username><id>7</id>",
    text_open: str = '<text xml:space="preserve">',
    indent: str = "  ",
) -> str:
    lines = [f"{indent}<page>", f"<title>{title}</title>", "<ns>0</ns>"]
    if doc_id is not None:
        lines.append(f"<id>{doc_id}</id>")
    lines += ["<revision>", "<id>31</id>" if doc_id is not None else ""]
    lines.append("<timestamp>2021-03-05T09:08:07Z</timestamp>")
    if contributor is not None:
        lines.append(f"<contributor>{contributor}</contributor>")
    lines.append("<comment>a note</comment>")
    if text is not None:
        lines.append(f"{text_open}{text}</text>")
    lines += ["</revision>", f"{indent}</page>"]
    return "\n".join(lines) + "\n"


#: Written for these cases: ids whose order as numbers is not that as strings (1003, 250, 400,
#: 61, 7, 95); "and" in every page; "tin" and "lamps" most often in another page than the
#: first; "glass", "dim" and "quartz" with equal frequencies.
SMALL_TEXTS = {
    95: "Lamps glow, and lamps dim; lamps rest.",
    400: "And then nobody spoke.",
    7: "Quartz and glass and tin",
    1003: "Dim glass (and Quartz glow)",
    61: "and-and glass!",
    250: "Nobody paints tin lamps and tin frogs",
}
#: Its opening tag goes over two lines.
BROKEN_TAG = 61


def small_dump() -> str:
    broken = '<text\n xml:space="preserve">'
    return (
        HEADER
        + "".join(
            page(str(i), text, title=f"Note {i}", **({"text_open": broken} if i == BROKEN_TAG else {}))
            for i, text in SMALL_TEXTS.items()
        )
        + FOOTER
    )


LONG_WORD = "x" * 51


def edge_dump() -> str:
    """One page per special case; comments give what is expected."""
    pages = [
        page("1", "", text_open='<text bytes="0" />').replace("</text>", ""),  # no text
        page("3", ""),  # empty text
        page(None, "No id here", contributor=None),  # no id at all
        page("abc", "Not a number"),  # id is not a number
        page("5", "Indexed without editor", contributor=None),  # no metadata row
        page("6", "Edited by an address", contributor="<ip>10.1.1.1</ip>"),  # empty name and id
        page("7", "Commas", title="One, two, three", contributor="<username>A, B</username><id>9</id>"),
        page("8", "See &lt;ref&gt; and \U0001f600 smile", title="Entités Été"),
        page("9", f"short {LONG_WORD} end"),
        page("13", "12345 67890 !!"),  # no letters
        page("14", "中文\U0001f600 word éclair WORD"),
    ]
    cut = "  <page>\n<title>Cut</title>\n<id>15</id>\n<text>never closed"
    return HEADER + "".join(pages) + cut
