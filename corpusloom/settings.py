"""What a deployment names for itself: journal code, mirror host, labels of sources. Operators take these, never constants."""

from __future__ import annotations

from dataclasses import dataclass, field


#: Titles of entries that have no author by their nature, whatever the case.
PROCEDURAL_TITLES = (
    r"^notes?$", r"^reviews?$", r"^book reviews?$", r"^news\b", r"^notes? and news$", r"^announcements?$", r"^session\b.*discussion$", r"^discussions?$", r"^supplement\b", r"^supplements$", r"^new publications$", r"^erratum$", r"^contents$", r"^editorial$", r"^guest editorial$", r"^obituary\b",
    r"^orbituay\b", r"^book received\b", r"^books received\b", r"^annual contents\b", r"^cumulative index\b", r"^notices?\b", r"^notice of journals\b", r"^conferences?$", r"^correspondence\b", r"^publication on history of science$", r"^academy publications?\b", r"^projects approved\b", r"^indian national commission\b", r"^chama newsletter$", r"^form iv$", r"^awards and honours$")


@dataclass(frozen=True)
class Settings:
    journal_code: str = "JRNL"
    journal_name: str = "Journal of Record"
    portal_host: str = "portal.example.org"
    mirror_token: str = "mirror.example.org"
    mirror_prefix: str = "https://mirror.example.org/papers/"
    mirror_base: str = "https://mirror.example.org/assets/"
    link_host: str = "magazine.example.com"
    link_label: str = "magazine"
    portal_label: str = "portal"
    session_segment: str = "(S(session))"
    short_volume: tuple[str, str] = ("/Vol9_", "/Vol09_")
    affiliated_keywords: str = "affiliated mirror"
    mirror_keywords: str = "mirror"
    archive_route: str = "/archive?file="
    buckets: tuple[str, str] = ("main", "other")
    main_author: str = "House Author"
    ingest_category: str = "Indic"
    stored_segment: str = "writereaddata"
    session_mark: str = "(S("
    listing_marker: str = "| # | Journal |"
    procedural_titles: tuple[str, ...] = PROCEDURAL_TITLES
    name_rules: tuple = (("prefix", "annals_", "Annals", "third"), ("prefix", "BULL_", "Bulletin", "spaces"), ("prefix", "own-", "Other", "tail"), ("contains", "gazette", "Gazette", "cased"))
    enrichment_fallbacks: tuple = field(default_factory=tuple)

    @property
    def journal_pattern(self) -> str:
        return rf"(?i){self.journal_code}\D\d+\D(\d{{4}})\D"
