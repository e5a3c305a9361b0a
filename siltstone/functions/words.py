"""Word lists, names, formats and patterns that results depend on."""

from __future__ import annotations

LIGATURES = (("ﬁ", "fi"), ("ﬂ", "fl"), ("ﬃ", "ffi"), ("ﬄ", "ffl"))

FORMATS = (
    ("pdf", ("pdf",)),
    ("html", ("html", "htm")),
    ("md", ("md", "markdown")),
    ("txt", ("txt",)),
    ("json", ("json",)),
    ("csv", ("csv",)),
    ("xlsx", ("xlsx",)),
    ("xls", ("xls",)),
    ("image", ("png", "jpg", "jpeg", "tif", "tiff")),
    ("pbf", ("pbf",)),
)
FORMAT_ALIASES = {"jpg": "image", "jpeg": "image", "png": "image", "tif": "image", "tiff": "image", "htm": "html", "markdown": "md"}

LANGUAGE_STOP_WORDS = (
    ("es", ("el", "la", "los", "las", "que", "del", "para", "una")),
    ("en", ("the", "and", "of", "for", "with", "from", "this")),
    ("pt", ("o", "a", "os", "as", "que", "para", "uma", "dos")),
)

TOC_NAMES = (
    "table of contents", "contents", "content", "index of contents",
    "tabla de contenido", "tabla de contenidos", "indice de contenidos",
    "índice de contenidos", "índice", "indice", "sommaire", "sumário",
    "sumario", "目次", "tabela de conteúdos", "tabela de conteudos",
    "table des matières", "table des matieres", "index des matières",
    "index des matieres",
)
TOC_STARTS = (r"table\s+of\s+content", r"tabla\s+de\s+conten", r"indice\s+de\s+conten", r"índice\s+de\s+conten", r"table\s+content", r"contents\s+and\s+")
TOC_TERMS = (
    "table of contents", "contents", "indice", "índice", "introduction",
    "acknowledgements", "acknowledgments", "appendix", "methodology",
    "references", "chapter", "annex", "tabla de contenido", "agradecimientos",
    "apéndice", "metodología", "referencias", "capítulo",
    "referências", "bibliografia", "tabela de conteúdos", "sumário",
    "références", "bibliographie", "table des matières", "sommaire",
)
END_MATTER_NAMES = (
    "references", "reference", "bibliography", "bibliographies",
    "referencias", "referencia", "bibliografía", "bibliografías",
    "works cited", "literatura citada", "fuentes consultadas",
    "acknowledgements", "acknowledgments", "agradecimientos",
    "how to cite", "cómo citar", "como citar", "citation", "citations",
    "credits", "créditos", "creditos", "about the authors",
    "author biographies", "biografías de los autores", "glossary", "glosario",
    "index", "índice analítico", "indice analitico",
    "referências", "bibliografia", "obras citadas", "fontes consultadas",
    "références", "bibliographie", "ouvrages cités", "ouvrages cites",
    "sources consultées", "sources consultees", "agradecimentos",
    "remerciements", "comment citer", "sobre os autores", "a propos des auteurs",
    "à propos des auteurs", "biografias dos autores", "glossário", "glossario",
    "glossaire",
    "how to cite this report", "cómo citar este informe", "como citar este relatório",
    "como citar este relatorio", "comment citer ce rapport",
    "references and further reading", "referencias y lecturas adicionales",
    "referências e leituras adicionais", "références et lectures complémentaires",
    "references / bibliography", "referencias / bibliografía",
    "referências / bibliografia", "références / bibliographie",
)

CONTINUATION_CONNECTORS = (
    "además", "asimismo", "también", "de igual manera", "del mismo modo",
    "por otra parte", "por otro lado", "igualmente", "en este sentido",
    "en consecuencia", "por consiguiente", "therefore", "furthermore",
    "moreover", "also", "in addition", "likewise", "similarly",
    "além disso", "ademais", "da mesma forma",
)
CHANGE_CONNECTORS = (
    "sin embargo", "no obstante", "en cambio", "por el contrario",
    "finalmente", "en conclusión", "conclusión", "however", "nevertheless",
    "in contrast", "on the other hand", "finally", "in conclusion",
    "contudo", "porém", "em contraste",
)
ANAPHORIC_STARTS = (
    "este ", "esta ", "estos ", "estas ", "dicho ", "dicha ",
    "tales ", "ello ", "ellos ", "ellas ", "the same ", "this ",
    "these ", "such ", "it ", "they ", "isso ", "essa ",
)
CONTINUITY_STOP_WORDS = (
    "el", "la", "los", "las", "un", "una", "unos", "unas", "de", "del",
    "y", "o", "en", "por", "para", "con", "que", "se", "su", "sus",
    "a", "al", "como", "más", "muy", "es", "son", "this", "that", "the",
    "and", "or", "of", "to", "in", "for", "with", "as", "is", "are",
)

ABBREVIATIONS = (
    "sr.", "sra.", "dr.", "dra.", "prof.", "pág.", "págs.", "no.",
    "núm.", "etc.", "e.g.", "i.e.", "vs.", "fig.", "figs.", "inc.",
    "mr.", "mrs.", "ms.", "st.", "jan.", "feb.", "mar.", "apr.",
    "jun.", "jul.", "aug.", "sep.", "sept.", "oct.", "nov.", "dec.",
)

REFERENCE_HEADING = r"^(?i)(?:references|bibliography|works cited|sources|referencias|bibliograf[ií]a|fuentes|notas)$"
CONTENT_HEADING = r"(?i)\b(?:chapter|section|introduction|overview|conclusion|methodology|results|technical performance|research and development|bibliography|references|index)\b"
KEPT_HEADINGS = ("introduction", "overview", "annual report", "symbols", "report highlights", "top takeaways")
REMOVABLE_HEADINGS = ("table of contents", "contents", "acknowledgements", "acknowledgments", "public data and tools", "get involved")

JSON_METADATA_KEYS = (
    "url", "date", "published", "authors", "author", "tags", "id", "source",
    "license", "language", "lang", "created_at", "updated_at", "src", "href",
    "detail_url", "pdf_url", "doi",
)
JSON_IGNORED_KEYS = ("links", "pdf_links", "doc_links")
HTML_DROPPED_TAGS = ("script", "style", "noscript", "svg", "nav", "footer", "form", "aside")

ALERT_LABELS = {
    "codigo": "Código", "code": "Código", "fecha": "Fecha", "fecha_emision": "Fecha", "date": "Fecha",
    "municipio": "Municipios", "municipios": "Municipios", "tipo": "Tipo", "type": "Tipo",
}

ENTITY_FIELDS = ("au_ID_concatenated", "b_ID_concatenated")
ENTITY_PAIRS = (("admin", ("b_ADM1_PCODE", "b_ADM2_PCODE")), ("feature", ("layer", "fid")))

ENTITY_KINDS = (
    "person", "organization", "country", "location", "technology", "scientific concept",
    "space mission", "international treaty", "political event", "institution", "date",
)
RELATION_KINDS = (
    "develops", "uses", "located_in", "participates_in", "regulates", "signed", "cooperates_with", "affects", "related_to",
)

# Patterns, in the syntax of Java's regular expressions (SENTENCE in Python's).
MOJIBAKE = "(?:Ã.|Â.|â(?:€|–|—|…)|Ëœ|�)"
ROW_MARKER = r"^(?i)\s*\[fila\s+\d+\]\s*[:\-]?\s*"
BROKEN_URL = r"(?i)(https?://\S+)\n(\S+)"
MARKDOWN_LINK = r"!?\[([^\]]+)\]\([^)]*\)"
HTML_TAG = r"</?[A-Za-z][^>]*>"
HEADING_MARK = r"^\s{0,3}#{1,6}\s*"
LIST_MARK = r"^\s{0,3}(?:[-*+]\s+|\d+[.)]\s+)"
MEANINGFUL_NUMBER = r"[%$€£¥₹]|\b(?:19|20)\d{2}\b"
PAGE_NUMBER = r"^(?i)(?:página|page)?\s*[-–—]?\s*\d{1,4}\s*$"
BANG_LINE = r"^(?:!\s*!|!\s*\d{1,4})$"
EXTRACTION_MARK = r"^\s*(?:!+\s*\d+|!{2,}|[~`^]+)\s*$"
PAGE_MARK = r"^(?i)\s*\*?\s*<!--\s*(?:p[áa]gina|page)\s+\d+\s*-->\s*\*?\s*$"
REFERENCE_LINE = r"^\s*(?:\[\d+\]|\d+[.)])\s+"
NUMBERED_HEADING = r"^(?i)(?:chapter|chap\.?|part|section|appendix)\s+[a-z]?\d+(?:\s+(?:preview|highlights?))?\s*$"
NUMBER_BEFORE_CAPITAL = r"^\d+(?:\.\d+)?%?\s+[A-Z]"
NUMBER = r"\b\d[\d,.%$-]*\b"
HEADING = r"^\s{0,3}#{1,6}\s+(.+?)\s*$"
TOC_ENTRY = r"^(?:[-*+•]\s+)?(?:\d+(?:\.\d+)*[.)]?\s+)?.+?(?:\.{2,}|\s)\s*\d{1,4}\s*$"
TOC_NUMBERED = r"^\s*\d+(?:\.\d+)*[.)]?\s+.{2,100}(?:\s+\d{1,4})?\s*$"
TABLE_RULE = r"^\s*\|?\s*:?-{2,}:?\s*(?:\|\s*:?-{2,}:?\s*)+\|?\s*$"
BULLET = r"^\s*[•▪◦‣⁃∙·●○■□➢➤-]\s+"
SENTENCE = r"\S.*?(?:[.!?。！？]+(?=\s|$)|$)"
LABEL = r"^([A-Za-z0-9_$.\[\]-]+):\s*(.*)$"

#: Experiments, as (configuration, corpus, folder of its PDF chunks).
EXPERIMENTS = (
    ("01_bge_m3_corpus", "corpus_bge_m3_standard", "pdfs_standard_objetivo-200palabras_max-250_solapamiento-0_bge_m3"),
    ("02_hibrido_granite_late_pdf", "corpus_bge_m3_granite_late_pdf", "pdfs_late_chunking_objetivo-200palabras_max-250_solapamiento-0_granite_pdf"),
    ("03_granite_corpus", "corpus_granite_standard", "pdfs_standard_objetivo-200palabras_max-250_solapamiento-0_granite"),
    ("04_bge_m3_overlap_1", "corpus_bge_m3_overlap_1", "pdfs_standard_objetivo-200palabras_max-250_solapamiento-1_bge_m3_overlap_1"),
    ("05_granite_overlap_1", "corpus_granite_overlap_1", "pdfs_standard_objetivo-200palabras_max-250_solapamiento-1_granite_overlap_1"),
    ("06_bge_m3_semantic_pdf", "corpus_bge_m3_semantic_pdf", "pdfs_semantic_objetivo-200palabras_max-250_solapamiento-0_bge_m3_semantic"),
)
