"""What differs from one document source to the next: one profile per source."""

from __future__ import annotations

from dataclasses import dataclass


@dataclass(frozen=True)
class SourceProfile:
    search_url: str = "https://decisions.example.test/en/search/"
    allowed_domain: str = "example.test"

    # --- fixed values: comments a server stamps into a page on every render (bytes patterns) ---
    volatile_comments: tuple[tuple[str, str], ...] = (
        (r"<!--\s*Elapsed time:[^>]*-->", "<!-- Elapsed time -->"),
        (r"<!--\s*cached or not being index\.aspx page\s*-->", ""),
    )

    # --- fixed values: listing page selectors ---
    body_group: str = "#CB2"
    body_checkbox: str = "input[type=checkbox]"
    card: str = "li.each-item"
    card_reference: str = "span.refNO"
    card_link: str = "h2.title a"
    card_description: str = "p.description"
    card_date: str = "span.date"
    result_head: str = ".searchhead"
    next_link: str = "ul.pager a.next"

    # --- fixed values: document page selectors ---
    containers: tuple[str, ...] = ("div.content", "main", "#content", "div.col-sm-9", "article")
    ui: tuple[str, ...] = (
        "script",
        "style",
        "noscript",
        "iframe",
        "nav",
        "header",
        "footer",
        "form",
        "button",
        "input",
        "select",
        "[role=navigation]",
        "[role=banner]",
        "[role=contentinfo]",
        ".cookie",
        ".top-header",
        ".logo-header",
        ".searchbanner",
        ".social-banner",
        ".language-switch",
        ".google-translate",
        ".resize",
        ".return-to-search",
        ".GAButton",
        ".btn",
        ".pager",
        ".sr-only",
        ".skiplink-text",
    )
    kept_attributes: tuple[str, ...] = (
        "href",
        "src",
        "alt",
        "title",
        "colspan",
        "rowspan",
        "lang",
    )


DEFAULT_PROFILE = SourceProfile()
