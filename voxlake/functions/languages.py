"""Fixed values of the languages: names, codes, limits, abbreviations and symbols."""

# Language name -> translation code; other names give {name}_Latn.
TRANSLATION_CODES = {
    "spanish": "spa_Latn", "french": "fra_Latn", "german": "deu_Latn", "italian": "ita_Latn", "portuguese": "por_Latn",
    "russian": "rus_Cyrl", "chinese": "zho_Hans", "japanese": "jpn_Jpan", "korean": "kor_Hang", "arabic": "arb_Arab",
    "hindi": "hin_Deva", "bengali": "ben_Beng", "dutch": "nld_Latn", "swedish": "swe_Latn", "norwegian": "nob_Latn",
    "danish": "dan_Latn", "finnish": "fin_Latn", "polish": "pol_Latn", "czech": "ces_Latn", "hungarian": "hun_Latn",
    "romanian": "ron_Latn", "bulgarian": "bul_Cyrl", "greek": "ell_Grek", "turkish": "tur_Latn", "hebrew": "heb_Hebr",
    "thai": "tha_Thai", "vietnamese": "vie_Latn", "indonesian": "ind_Latn", "malay": "msa_Latn", "filipino": "fil_Latn",
    "urdu": "urd_Arab", "persian": "pes_Arab", "swahili": "swh_Latn", "yoruba": "yor_Latn", "igbo": "ibo_Latn",
    "hausa": "hau_Latn", "amharic": "amh_Ethi", "somali": "som_Latn", "zulu": "zul_Latn", "xhosa": "xho_Latn",
    "afrikaans": "afr_Latn",
}

# Three-letter -> two-letter codes.
TWO_LETTERS = {
    "eng": "en", "spa": "es", "fra": "fr", "deu": "de", "por": "pt", "ita": "it", "pol": "pl", "ara": "ar", "zho": "zh-cn", "ces": "cs",
    "rus": "ru", "nld": "nl", "tur": "tr", "hun": "hu", "kor": "ko", "jpn": "ja", "hin": "hi", "urd": "ur", "snd": "sd",
}

# Languages that synthesis supports; others fall back to en.
SUPPORTED = ["en", "es", "fr", "de", "it", "pt", "pl", "tr", "ru", "nl", "cs", "ar", "zh-cn", "ja", "hu", "ko"]

# Most characters of a text by language.
CHAR_LIMITS = {
    "en": 250, "de": 253, "fr": 273, "es": 239, "it": 213, "pt": 203, "pl": 224, "zh": 82, "ar": 166, "cs": 186,
    "ru": 182, "nl": 251, "tr": 226, "ja": 71, "hu": 224, "ko": 95, "hi": 150, "ur": 150, "sd": 400,
}
DEFAULT_LIMIT = 250

# Lower limits of the synthesis step; a language's limit is the smaller of both, by default 150.
CAUTIOUS_LIMITS = {
    "es": 180, "en": 200, "fr": 170, "de": 160, "it": 180, "pt": 180, "ru": 150, "zh": 120, "ja": 120, "ko": 120,
    "ar": 140, "hi": 140, "tr": 160, "pl": 160, "cs": 160, "nl": 170, "hu": 150, "ur": 150, "sd": 180,
}
CAUTIOUS_DEFAULT = 150

# Codes of languages and their names, for lookups by name in any case.
LANGUAGE_NAMES = {
    "en": "english", "zh": "chinese", "de": "german", "es": "spanish", "ru": "russian", "ko": "korean", "fr": "french", "ja": "japanese",
    "pt": "portuguese", "tr": "turkish", "pl": "polish", "ca": "catalan", "nl": "dutch", "ar": "arabic", "sv": "swedish", "it": "italian",
    "id": "indonesian", "hi": "hindi", "fi": "finnish", "vi": "vietnamese", "iw": "hebrew", "uk": "ukrainian", "el": "greek", "ms": "malay",
    "cs": "czech", "ro": "romanian", "da": "danish", "hu": "hungarian", "ta": "tamil", "no": "norwegian", "th": "thai", "ur": "urdu",
    "hr": "croatian", "bg": "bulgarian", "lt": "lithuanian", "la": "latin", "mi": "maori", "ml": "malayalam", "cy": "welsh", "sk": "slovak",
    "te": "telugu", "fa": "persian", "lv": "latvian", "bn": "bengali", "sr": "serbian", "az": "azerbaijani", "sl": "slovenian", "kn": "kannada",
    "et": "estonian", "mk": "macedonian", "br": "breton", "eu": "basque", "is": "icelandic", "hy": "armenian", "ne": "nepali", "mn": "mongolian",
    "bs": "bosnian", "kk": "kazakh", "sq": "albanian", "sw": "swahili", "gl": "galician", "mr": "marathi", "pa": "punjabi", "si": "sinhala",
    "km": "khmer", "sn": "shona", "yo": "yoruba", "so": "somali", "af": "afrikaans", "oc": "occitan", "ka": "georgian", "be": "belarusian",
    "tg": "tajik", "sd": "sindhi", "gu": "gujarati", "am": "amharic", "yi": "yiddish", "lo": "lao", "uz": "uzbek", "fo": "faroese",
    "ht": "haitian creole", "ps": "pashto", "tk": "turkmen", "nn": "nynorsk", "mt": "maltese", "sa": "sanskrit", "lb": "luxembourgish", "my": "myanmar",
    "bo": "tibetan", "tl": "tagalog", "mg": "malagasy", "as": "assamese", "tt": "tatar", "haw": "hawaiian", "ln": "lingala", "ha": "hausa",
    "ba": "bashkir", "jw": "javanese", "su": "sundanese",
}

# Other names of languages.
LANGUAGE_ALIASES = {
    "burmese": "my", "valencian": "ca", "flemish": "nl", "haitian": "ht", "letzeburgesch": "lb", "pushto": "ps", "panjabi": "pa",
    "moldavian": "ro", "moldovan": "ro", "sinhalese": "si", "castilian": "es",
}

# Abbreviation (followed by a dot; in Russian by a word's end) -> word.
ABBREVIATIONS = {
    "en": {"mrs": "misess", "mr": "mister", "dr": "doctor", "st": "saint", "co": "company", "jr": "junior", "maj": "major", "gen": "general", "drs": "doctors", "rev": "reverend", "lt": "lieutenant", "hon": "honorable", "sgt": "sergeant", "capt": "captain", "esq": "esquire", "ltd": "limited", "col": "colonel", "ft": "fort"},
    "es": {"sra": "señora", "sr": "señor", "dr": "doctor", "dra": "doctora", "st": "santo", "co": "compañía", "jr": "junior", "ltd": "limitada"},
    "fr": {"mme": "madame", "mr": "monsieur", "dr": "docteur", "st": "saint", "co": "compagnie", "jr": "junior", "ltd": "limitée"},
    "de": {"fr": "frau", "dr": "doktor", "st": "sankt", "co": "firma", "jr": "junior"},
    "pt": {"sra": "senhora", "sr": "senhor", "dr": "doutor", "dra": "doutora", "st": "santo", "co": "companhia", "jr": "júnior", "ltd": "limitada"},
    "it": {"sig": "signore", "dr": "dottore", "st": "santo", "co": "compagnia", "jr": "junior", "ltd": "limitata"},
    "pl": {"p": "pani", "m": "pan", "dr": "doktor", "sw": "święty", "jr": "junior"},
    "cs": {"dr": "doktor", "ing": "inženýr", "p": "pan"},
    "ru": {"г-жа": "госпожа", "г-н": "господин", "д-р": "доктор"},
    "nl": {"dhr": "de heer", "mevr": "mevrouw", "dr": "dokter", "jhr": "jonkheer"},
    "tr": {"b": "bay", "byk": "büyük", "dr": "doktor"},
    "hu": {"dr": "doktor", "b": "bácsi", "nőv": "nővér"},
}

# Symbol -> word, with blanks around it.
SYMBOLS = {
    "en": {"&": "and", "@": "at", "%": "percent", "#": "hash", "$": "dollar", "£": "pound", "°": "degree"},
    "es": {"&": "y", "@": "arroba", "%": "por ciento", "#": "numeral", "$": "dolar", "£": "libra", "°": "grados"},
    "fr": {"&": "et", "@": "arobase", "%": "pour cent", "#": "dièse", "$": "dollar", "£": "livre", "°": "degrés"},
    "de": {"&": "und", "@": "at", "%": "prozent", "#": "raute", "$": "dollar", "£": "pfund", "°": "grad"},
    "pt": {"&": "e", "@": "arroba", "%": "por cento", "#": "cardinal", "$": "dólar", "£": "libra", "°": "graus"},
    "it": {"&": "e", "@": "chiocciola", "%": "per cento", "#": "cancelletto", "$": "dollaro", "£": "sterlina", "°": "gradi"},
    "pl": {"&": "i", "@": "małpa", "%": "procent", "#": "krzyżyk", "$": "dolar", "£": "funt", "°": "stopnie"},
    "ar": {"&": "و", "@": "على", "%": "في المئة", "#": "رقم", "$": "دولار", "£": "جنيه", "°": "درجة"},
    "ur": {"&": "اور", "@": "پر", "%": "فیصد", "#": "ہیش", "$": "ڈالر", "£": "پاؤنڈ", "°": "ڈگری", "*": "ستارہ", "!": "اچھا"},
    "sd": {"&": "۽", "@": "تَي", "%": "سيڪڙَو", "#": "هَيش", "$": "ڊالر", "£": "پائونڊ", "°": "ڊگري", "*": "تارَو"},
    "zh": {"&": "和", "@": "在", "%": "百分之", "#": "号", "$": "美元", "£": "英镑", "°": "度"},
    "cs": {"&": "a", "@": "na", "%": "procento", "#": "křížek", "$": "dolar", "£": "libra", "°": "stupně"},
    "ru": {"&": "и", "@": "собака", "%": "процентов", "#": "номер", "$": "доллар", "£": "фунт", "°": "градус"},
    "nl": {"&": "en", "@": "bij", "%": "procent", "#": "hekje", "$": "dollar", "£": "pond", "°": "graden"},
    "tr": {"&": "ve", "@": "at", "%": "yüzde", "#": "diyez", "$": "dolar", "£": "sterlin", "°": "derece"},
    "hu": {"&": "és", "@": "kukac", "%": "százalék", "#": "kettőskereszt", "$": "dollár", "£": "font", "°": "fok"},
    "ko": {"&": "그리고", "@": "에", "%": "퍼센트", "#": "번호", "$": "달러", "£": "파운드", "°": "도"},
    "hi": {"&": "और", "@": "ऐट दी रेट", "%": "प्रतिशत", "#": "हैश", "$": "डॉलर", "£": "पाउंड", "°": "डिग्री"},
}
