"""Word lists, patterns and tables on which results depend."""

# Function words of Basque and Spanish. Entries with accents never match, as the text they meet has none.
EU_STOPWORDS = """eta da ez bat zer nola baina ere zen dut du dute den dela dago daude gara dira ziren
zuen zuten izango izaten behar baino bai hau hori hura hauek horiek haiek nik zuk hark guk zuek nire zure bere gure
haien honetan horretan hartan diren duen duten arte aurre gain alde kontra bidez baitan bitarte batera oraindik orain
bertan han hemen oso asko gutxi gehiago gutxiago beti inoiz egun urte aste hilabete lege araudi agindu
xedapen arau batzorde sail eusko jaurlaritza herri euskal autonomia erkidego""".split()
ES_STOPWORDS = """de la el en y a los del se las un por con una su al lo como más pero sus le ya o fue este ha sí
porque esta son entre cuando muy sin sobre también me hasta hay donde quien desde todo nos durante estados todos uno
les ni contra otros ese eso ante ellos e esto mí antes algunos qué unos yo otro otras él tanto esa estos mucho quienes
ley decreto reglamento artículo gobierno vasco euskadi disposición normativa""".split()

# Three-character pieces typical of each language; _ stands for a blank.
EU_TRIGRAMS = [t.replace("_", " ") for t in "ari era ren ean tze nda eko eta ain kor arr irr zko ald ber har tar lar egi len bat ara kin all urr gai kon ran dak rak rre tik tzu zut uts".split()]
ES_TRIGRAMS = [t.replace("_", " ") for t in "ión de_ _de los las que _la la_ _el el_ nte ció est del con ado ara ien ter par _en en_ pro tra mie nto ect pre res com are ble ber uci _es es_ ste aci".split()]

# Endings and words that count as a language's pattern.
EU_GENITIVES = "arena aren arenak arengandik arentzat".split()
EU_VERBAL = "ekin tzeko tzean tzetik tzera".split()
EU_PARTICLES = "ez bai baina ere".split()
EU_LOCATIVES = "ko ka ke ki".split()
EU_CLUSTERS = "tt dd rr ts tz tx".split()
EU_ADMIN = "urruntze bilketa aginpide eskumen".split()
ES_ENDINGS = "ción ciones miento mientos idad idades".split()
ES_ACCENTED = "él más así también además según través".split()
ES_GERUNDS = "ando endo iendo".split()
ES_LEGAL = "artículo decreto ley reglamento disposición".split()

#: Weights of the three signals, least confidence, least characters.
W_STOPWORD, W_TRIGRAM, W_PATTERN = 0.45, 0.30, 0.25
LEAST_CONFIDENCE, LEAST_CHARS = 0.52, 15

# Terms of each domain with their weights, in the order that settles ties.
DOMAIN_TERMS = {
    "legal": {2: "ley, decreto, reglamento, normativa, juzgado, sentencia, tribunal, vigencia, lege, dekretua, araudi, xedapen, ebazpen, agindua, epai, auzitegi, indarrean", 1: "orden, acuerdo, contrato, convenio, derecho, expediente, registro, oficial, araua, eskubide, betebehar, zigor, kontratuak, argitarapen"},
    "health": {2: "salud, sanidad, sanitario, sanitaria, hospital, farmacia, medicamento, paciente, enfermedad, tratamiento, epidemia, vacuna, servicio social, discapacidad, osakidetza, osasuna, osasungintza, ospitale, botika, gaixo, gaixotasun, tratamendu, prebentzio, txertoa, gizarte zerbitzu, desgaitasun", 1: "asistencia, higiene, dependencia, bienestar, social, mendetasun, ongizate"},
    "education": {4: "ikastola, hezkuntza", 2: "escuela, colegio, universidad, docente, asignatura, bachillerato, primaria, secundaria, beca, lanbide, ikasle, irakasle, eskola, unibertsitate, curriculum, ikasketa, titulazio, lanbide heziketa, irakaskuntza, beka", 1: "alumno, profesor, materia, grado, infantil, aprendizaje, ebaluazio"},
    "fiscal": {2: "impuesto, tributario, tributo, fiscal, hacienda, presupuesto, irpf, iva, base imponible, contribuyente, obligado tributario, agencia tributaria, zerga, ogasun, aurrekontu, bilketa, pfez, bfa, aitorpen, itzulketa, kenkaria, salbuespena, zergadun, lizitazio, kontratazio publiko", 1: "renta, tipo, ingreso, gasto, partida, diru sarrera, gastuak"},
}
DOMAIN_THRESHOLD, DOMAIN_LEAST_CHARS = 0.30, 10

# Characters that the cleaner maps to blanks, to nothing, or to plain quotes and dashes.
TO_BLANK = "\u00a0\u2007\u2009\u202f"
TO_NOTHING = "\u200b\u200c\u200d\u2060\ufeff"
QUOTES = {"“": '"', "”": '"', "„": '"', "‘": "'", "’": "'", "‐": "-", "–": "-", "—": "-"}
ELLIPSIS = "…"
TEXT_KEYS = ("text", "content", "value", "line", "paragraph", "span", "title", "caption", "heading")

#: Node types whose bare names may stand for a node of the parent's own document.
BASE_TYPES = ("pages", "words", "lines", "spans", "paragraphs", "boundingRegions", "styles")
RELATION_TYPE_COLUMNS = ("type", "relation", "rel", "edge_type")
EDGE_TYPE = "TIENE"


def terms(domain: str, words: int) -> dict[int, list[str]]:
    """Weight to the domain's terms of so many words."""
    return {w: [t for t in s.split(", ") if t.count(" ") == words - 1] for w, s in DOMAIN_TERMS[domain].items()}
