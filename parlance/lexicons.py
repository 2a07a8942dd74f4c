"""Small word tables. All are plain data: pass others to the operators that take them."""

from __future__ import annotations

# Short answers that keep a conversation going, by profile.
BACKCHANNELS = {
    "default": ("um", "uh", "uhh", "hmm", "ah", "ahh", "ok", "okay", "yeah", "yes", "no", "right", "sure", "mhm"),
    "hindi": ("haan", "ha", "achha", "acha", "theek", "theek hai", "sahi", "bilkul", "hmm", "hm", "arre", "oh", "wah", "waah", "bas", "na", "nahi", "matlab", "toh", "bhai", "yaar"),
    "punjabi": ("haan", "ha", "achha", "theek", "theek hai", "sahi", "bilkul", "hmm", "oh", "arre", "wah", "waah", "bas", "na", "nahi", "yaar"),
    "marwadi": ("haan", "ha", "achha", "theek", "hmm", "arre", "wah", "bas", "na"),
    "indian_english": ("yeah", "yes", "no", "ok", "okay", "right", "sure", "hmm", "uh", "um", "mhm", "ah", "oh", "i see", "got it"),
    "hinglish": ("haan", "ha", "achha", "acha", "theek", "hmm", "ok", "okay", "yeah", "yes", "right", "arre", "wah", "bas", "na", "nahi", "matlab", "toh"),
}
# The profile of a base language.
PROFILES = {"hi": "hindi", "pa": "punjabi", "mwr": "marwadi", "en": "indian_english", "hinglish": "hinglish"}

# Our own short lists of frequent words in Latin script; longer tables can be passed in their place.
ROMAN_HINDI = ("hai", "hain", "nahi", "nahin", "kya", "kyun", "kaise", "mera", "meri", "tera", "aap", "hum", "tum", "mein", "aur", "lekin", "bahut", "accha", "namaste", "thik", "abhi", "kal", "aaj", "raha", "rahi", "karo", "karna", "gaya", "tha", "thi", "kuch", "sab", "yeh", "woh")
ROMAN_PUNJABI = ("tusi", "tussi", "assi", "menu", "tenu", "kiven", "kidda", "changa", "vadiya", "sanu", "ohna", "kithe", "hunda", "karda", "kardi", "hega", "paaji", "sat", "sri", "akal", "nu", "vich")
ROMAN_MARWADI = ("mhare", "mharo", "tharo", "thare", "kain", "padharo", "ghano", "ghani", "sa", "khamma", "chhe", "konni", "hukum", "mhane", "thane", "bega")
# Words of other languages that also stand in looser lists; they count as Hindi or Punjabi only on demand.
LEGACY_COLLISIONS = {"hi": ("the", "be", "me", "main", "log", "tension"), "pa": ("de", "pair", "par", "la")}
MARWADI_DEVANAGARI = ("म्हारो", "म्हारे", "थारो", "थारे", "काईं", "पधारो", "घणो", "घणी", "खम्मा", "कोनी")
STOPWORDS = ("the", "and", "for", "are", "but", "not", "you", "all", "any", "can", "had", "her", "was", "one", "our", "out", "has", "have", "with", "this", "that", "from", "they", "will", "would", "there", "their", "what", "about", "which", "when", "make", "like", "hai", "hain", "nahi", "aur", "mein", "kya", "toh")
FILLERS = ("um", "uh", "uhh", "hmm", "ah", "er", "like", "matlab", "toh", "yaar", "you know")

# Language tags, display names and speech rates (mean, deviation in words a minute).
BCP47 = {"hi": "hi-Deva", "pa": "pa-Guru", "mr": "mr-Deva", "en": "en-IN", "hinglish": "hi-Latn", "ur": "ur-Arab", "gu": "gu-Gujr", "bn": "bn-Beng", "ta": "ta-Taml", "te": "te-Telu", "kn": "kn-Knda", "ml": "ml-Mlym", "mwr": "mwr-Latn"}
LANGUAGE_NAMES = {"hi": "Hindi", "en": "English", "pa": "Punjabi", "raj": "Marwadi", "mrw": "Marwadi"}
WPM = {"hi": (130.0, 30.0), "pa": (120.0, 28.0), "mwr": (110.0, 25.0), "en": (145.0, 35.0), "hinglish": (140.0, 32.0), "default": (135.0, 35.0)}
