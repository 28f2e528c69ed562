"""Controlled vocabularies. These lists decide results and are stated in full."""

from __future__ import annotations

# Main table, in contract order.
COLUMNS = [
    "rid", "dataset_name", "source_type", "source_description", "label", "date_iso", "url_review", "text", "text_clean", "text_no_url",
    "extracted_urls", "is_duplicated", "is_null", "too_short", "factcheck_rating", "factcheck_claimant", "factcheck_url",
    "char_len", "word_len", "num_exclamations", "num_questions", "num_ellipsis", "uppercase_word_ratio",
]
# Provenance side table.
PROVENANCE_COLUMNS = ["rid", "label_source", "text_role", "publisher", "lang_variant", "collector", "source_url", "collected_at", "rating_norm", "mentions_ai"]

# Ratings of plain falsehood.
FALSE_PURE = [
    "falso", "falsa", "errado", "errada", "mentira", "fake", "mentiroso", "montagem", "montagem.", "insustentavel", "sem registro", "satira",
    "manipulado", "manipulada", "pants on fire", "incorrect", "false", "falso.", "fake.", "errado.", "a sos", "impossivel", "forjado",
    "fabricado", "mentira.", "nao e verdade", "nao procede", "desmentido",
]
# Ratings of partial falsehood.
HARD = [
    "enganoso", "enganosa", "enganador", "distorcido", "distorcida", "sem contexto", "fora de contexto", "descontextualizado", "descontextualizada",
    "exagerado", "exagerada", "impreciso", "imprecisa", "esticado", "nao_e_bem_assim", "nao e bem assim", "verdadeiro, mas", "verdadeiro mas",
    "verdadeiro, mas...", "subestimado", "superestimado", "pimenta na lingua", "pimenta na língua", "misleading", "missing context",
    "out of context", "unverified", "mixed", "exaggerated", "partly false", "half true", "mais ou menos", "parcialmente", "meia verdade",
]
# Ratings of truth.
TRUE_RATING = [
    "verdadeiro", "verdadeira", "true", "certo", "certa", "correct", "praticamente certo", "praticamente verdadeiro", "verified", "comprovado",
    "comprovada", "accurate", "vdd", "verdade", "confirmado",
]
# The modelling side's smaller vocabulary.
MODEL_FALSE = ["falso", "errado", "fake", "mentira", "montagem", "insustentavel", "sem registro", "satira"]
MODEL_HARD = [
    "enganoso", "enganador", "distorcido", "sem contexto", "fora de contexto", "exagerado", "impreciso", "esticado", "nao_e_bem_assim",
    "nao e bem assim", "verdadeiro, mas", "verdadeiro mas", "subestimado", "superestimado",
]
MODEL_TRUE = ["verdadeiro", "certo", "praticamente certo"]

# Stop-words of claim matching, and of evidence overlap.
MATCH_STOP = """a o e de da do das dos em no na nos nas um uma para por com que se sobre entre apos ate como mais menos muito pouco ja nao sim
the of and to in for on with is are was were this that from by as at be or an it its""".split()
EVIDENCE_STOP = """a o e de da do das dos em no na nos nas um uma para por com que se sobre entre apos ate como mais menos muito pouco ja nao sim
ao aos as os the of and to in for on with is are was were this that from by as at be or an it its diz disse afirma afirmou segundo ainda tambem
pode ser vai vao foi sao era sera tem tinham ha havia falso falsa fake verdade verdadeiro verdadeira mentira desmente desmentido checamos procede
confirmado""".split()
# Ordinal words and their numbers.
ORDINALS = {
    "primeira": 1, "segunda": 2, "terceira": 3, "quarta": 4, "quinta": 5, "sexta": 6, "setima": 7, "oitava": 8, "nona": 9, "decima": 10,
    "primeiro": 1, "segundo": 2, "terceiro": 3, "quarto": 4, "quinto": 5, "sexto": 6, "setimo": 7, "oitavo": 8, "nono": 9, "decimo": 10,
}

# Words that give a verdict away, as one alternation between word boundaries.
LEAK = (
    r"\b(fake|falso|falsa|boato|mentira|mentiroso|farsa|verdadeiro|verdadeira|enganoso|enganador|checagem|checado|fact[- ]?check|#fato|#fake"
    r"|desment|e falso|é falso|e fake|é fake)\b"
)
# Mentions of artificial intelligence.
AI = (
    r"\b(ia|intelig[êe]ncia artificial|deepfake|deep fake|chatgpt|gpt|dall-?e|midjourney|stable diffusion|gerad[oa] por (ia|computador)"
    r"|imagem gerada|v[íi]deo gerado|bot|algoritmo)\b"
)
# Headlines that are no claims, and verbs that make one.
OPINION = (
    r"\b(an[aá]lise|opini[aã]o|coluna|editorial|artigo|ensaio|reflex[õo]es|cr[ôo]nica|resenha|entrevista|debate|podcast|vídeo|fotos|ao vivo"
    r"|elei[çc][õo]es 20\d\d|hor[óo]scopo|previs[ãa]o do tempo)\b"
)
CLAIM_VERB = (
    r"\b(e|é|foi|foram|ser[áa]|vai|v[ãa]o|tem|t[êe]m|havia|anunciou|aprovou|sancionou|assinou|lan[çc]ou|confirmou|negou|disse|afirmou|caiu"
    r"|subiu|aumentou|diminuiu|mata|morre|morreu|pro[íi]be|libera|autoriza|bloqueia|recusa|veta|diz|mostra|revela|denuncia|acusa)\b"
)
# Verdicts in a title, on normalised text.
TITLE_FALSE = r"\b(e falso que|e fake que|nao e verdade|nao procede|e mentira|desmente|checamos que e falso|e falso)\b"
TITLE_TRUE = r"\b(e verdade que|e verdadeiro que|confirmado|procede|checamos que e verdade|e verdade)\b"
# Dialect by web address: three and six domains.
PTPT_3 = r"poligrafo|observador|eco\.sapo\.pt"
PTPT_6 = r"poligrafo|observador|eco\.sapo\.pt|publico\.pt|dn\.pt|rtp\.pt"
# Metadata masks: persons, health, institutions.
MASKS = [
    (r"\b(lula|bolsonaro|dilma|temer|doria|ciro|haddad|moraes)\b", "[POLITICO]"),
    (r"\b(cloroquina|ivermectina|vacina|coronavac|pfizer|astrazeneca)\b", "[SAUDE]"),
    (r"\b(stf|tse|minist[eé]rio p[uú]blico)\b", "[INSTITUICAO]"),
]
# Regular personal data, masked in this order because each mask changes what the next one sees.
PII = [("email", r"[\w.+-]+@[\w-]+\.[\w.]+", "[EMAIL]"), ("cpf", r"\b\d{3}\.\d{3}\.\d{3}-\d{2}\b", "[CPF]"), ("telefone", r"(?:\+?55[\s.-]?)?(?:\(?\d{2}\)?[\s.-]?)?9?\d{4}[-\s]?\d{4}\b", "[TELEFONE]")]
# Channels by group, before the rules on prefixes.
CHANNELS = {
    "FakeWhatsApp.BR_2018": "whatsapp", "Fake.br": "portal", "Fake.br_raw": "portal", "COVID19.BR": "covid", "COVID19.BR_raw": "covid",
    "LLM4BR_300": "llm", "fakes": "agency_claim", "true": "press_true", "MuMiN-PT": "social", "MuMiN-PT_raw": "social",
}
BALANCED_GROUPS = ["Fake.br", "FakeWhatsApp.BR_2018", "COVID19.BR", "COVID19.BR_raw", "LLM4BR_300"]
# Rows wanted of each era.
ERA_GOALS = {"ate_2017": 30000, "2018_2022": 80000, "pos_gpt35": 80000}
# Label tiers, strongest first; a missing tier is weaker than all.
TIERS = {"v1": 1, "checker": 1, "correction": 1, "checker_match": 2, "llm_local": 3, "corroborated": 4, "provenance": 9, "unknown": 10}
# Code points of pictographs, dingbats, flags, arrows, variation selectors and the joiner.
EMOJI = r"[\x{1F000}-\x{1FAFF}\x{2600}-\x{27BF}\x{1F1E6}-\x{1F1FF}\x{2B00}-\x{2BFF}\x{FE00}-\x{FE0F}\x{200D}]+"
# White space as Unicode has it, spelled out so that every regular expression engine agrees.
SPACE = r"[\t-\r\x1C-\x20\x{85}\x{A0}\x{1680}\x{2000}-\x{200A}\x{2028}\x{2029}\x{202F}\x{205F}\x{3000}]"
LATIN_WORD = r"A-Za-zÀ-ÖØ-öø-ÿ"
