"""Fixed values that results depend on: word lists, alias tables, patterns and bounds."""

# Decade labels, first and last year of each; any other year gets DECADE_ELSE.
DECADES = [
    ("1970s", 1970, 1979),
    ("1980s", 1980, 1989),
    ("1990s", 1990, 1999),
    ("2000s", 2000, 2009),
    ("2010s", 2010, 2017),
]
DECADE_ELSE = "1960s"

# Genre flag rules as (flag, pattern to rewrite or None, rewritten to, needle pattern).
GENRE_RULES = [
    ("pop", "Pop", "pop", "pop"),
    ("rock", "Rock", "rock", "rock"),
    ("RandB", "Rhythm-and-blues|RandB|R&B", "randb", "rand"),
    ("soul", "Soul", "soul", "soul"),
    ("hiphop", "Hip-hop|Hip hop|hip hop", "hip-hop", "hip-hop"),
    ("rap", "Rap", "rap", "rap"),
    ("country", "Country", "country", "country"),
    ("dance", "Dance", "dance", "dance"),
    ("alternative_indie", None, None, "Alternative-indie|Alternative-Indie"),
    ("blues", "Blues", "blues", "blues"),
    ("disco", "Disco", "disco", "disco"),
    ("funk", "Funk", "funk", "funk"),
    ("jazz", "Jazz", "jazz", "jazz"),
    ("folk", "Folk", "folk", "folk"),
    ("easy_listenin", None, None, "Easy-listenin"),
    ("singer_songwriter", None, None, "songwriter"),
    ("electric", "Electric", "electric", "electric"),
    ("adult_contemporary", None, None, "Adult-contemporary"),
    ("punk", "Punk", "punk", "punk"),
    ("metal", "Metal", "metal", "metal"),
]
GENRES = [rule[0] for rule in GENRE_RULES]

# The genre text clean, applied in this order as (pattern, replacement).
GENRE_CLEAN = [
    (r"\(.*\)", ""),
    (r"&|'[nN]'", "and"),
    (r"[tT]he", ""),
    (r"in'|ing", "in"),
    (r"[^\p{L}\p{N}]+", "-"),
]

# Marks and patterns that frame a genre in a search text, and an address in one that cites a page.
GENRE_MARK = "Genre"
LENGTH_MARK = "Length"
AROUND_GENRE = "^.*Genre|Length.*$"
BEFORE_TITLE, AFTER_TITLE = "(?i)-*", ".*-*,*-*Genre[s]*-*"
CITES_PAGE = "wiki"
AROUND_ADDRESS = "(?s)^.*Wikipedia*|Cached.*$"

# Labels that stand in the genre column when no genre was found.
EXTRACTION_FAILED = "Extraction failed"
NO_GENRE = "No genre detected"
PAGE_MISSING = "Wiki page 404"

# Genre subsets used by the finished reports.
TFIDF_GENRES = ["rock", "RandB", "soul", "hiphop", "rap", "country", "dance"]
REPORT_GENRES = ["pop", "rap", "country", "blues", "dance"]

# Filler words left out of the word cloud.
CLOUD_DROP = ["yeah", "la", "ooh", "hey", "da", "uh", "yo", "na"]

# Request formats; %s takes the title or artist key.
GENRE_SEARCH_URL = "https://www.google.com/search?q=%s+%s+genre"
LYRIC_URL = "https://www.azlyrics.com/lyrics/%s/%s.html"

# Title aliases, applied in this order as (pattern, replacement).
TITLE_ALIASES = [
    ("Scarborough Fair", "Scarborough FairCanticle"),
    ("(Sweet Sweet Baby) Since You've Been Gone", "Since You've Been Gone"),
    ("Jumpin' Jack Flash", "Jumping Jack Flash"),
    ("Hurdy Gurdy Man", "The Hurdy Gurdy Man"),
    ("Do You Know the Way to San Jose", "Do You Know the Way to San Jos"),
    ("Sly and the Family Stone", "Sly&the Family Stone"),
    ("In the Year 2525", "In The Year 2525 (Exordium And Terminus)"),
    ("Sweet Cream Ladies", "Sweet Cream Ladies Forward March"),
    ("Neither One of Us (Wants to Be the First to Say Goodbye)", "Neither One of Us"),
    ("Gypsys, Tramps & Thieves", "Gypsys Tramps and Thieves"),
    ("(It's Just)", ""),
    ("Case of the Ex", "Case of the Ex What'cha Gonna Do"),
    ("Diary", "diary53795"),
    ("Live Like You Were Dying", "Live Like You Were Dyin"),
    ("Mr. Brightside", "Mr. Brightside39068"),
    ("How We Do", "This Is How We Do Fresh 83"),
    ("Snap Yo Fingers", "Snap Ya Fingers"),
    ("(When You Gonna) Give It Up to Me", "Give It Up to Me"),
    ("Black Horse and the Cherry Tree", "Black Horse & the Cherry Tree"),
    ("Déjà Vu", "djvu"),
    ("I Think They Like Me", "oh I Think They Like Me"),
    ("Crank That (Soulja Boy)", "Crank dat (Soulja Boy)"),
    ("Pop, Lock & Drop It", "Pop, Lock and Drop It"),
    ("Summer Love", "Summer Love Set The Mood Prelude"),
    ("I'm a Flirt", "I'm A Flirt (Remix)"),
    ("Big Shit Poppin' (Do It)", "Big Things Poppin' (Do It)"),
    ("Blame It", "Blame It (On The Alcohol)"),
    ("Yoü and I", "You and I"),
    ("Stronger (What Doesn't Kill You)", "What Doesn't Kill You Stronger"),
    ("Turn Me On", "Turning Me On"),
    ("I Don't Want This Night to End", "Don't Want This Night to End"),
    ("Habits (Stay High)", "Habits"),
    ("Hey Brother", "Brothersister"),
    ("Like I'm Gonna Lose You", "Like I'm going to Lose You"),
    ("Can't Feel My Face", "I Can't Feel My Face"),
]

# Artist aliases, applied in this order as (pattern, replacement).
ARTIST_ALIASES = [
    ("Paul Mauriat", "Johnny Mathis"),
    ("Paul Mauriat", "Johnny Mathis"),
    ("O. C. Smith", "Tony Bennett"),
    ("Hugh Masekela", "Raven Symone"),
    ("Merrilee Rush", "Juice Newton"),
    ("Hopkin", "Dolly Parton"),
    ("The Crazy World of Arthur Brown", "Emerson Lake Palmer"),
    ("Smokey Robinson and the Miracles", "Smokey Robinson&the Miracles"),
    ("Kenny Rogers and The First Edition", "Kenny Rogers"),
    ("Kenny Rogers & The First Edition", "Kenny Rogers"),
    ("Kenny Rogers & Kim Carnes", "Kenny Rogers"),
    ("Dottie West & Kenny Rogers", "Kenny Rogers"),
    ("Kenny Rogers and Sheena Easton", "Kenny Rogers"),
    ("Kenny Rogers and Dolly Parton", "Kenny Rogers"),
    ("Richard Harris", "Andy Williams"),
    ("José Feliciano", "Jose Feliciano"),
    ("Marvin Gaye & Tammi Terrell", "Marvin Gaye"),
    ("Diana Ross & Marvin Gaye", "Marvin Gaye"),
    ("Sérgio Mendes", "Sergio Mendes"),
    ("Lil Wayne, Wiz Khalifa and Imagine Dragons with Logic", "Lil Wayne"),
    ("Jay and the Americans", "Jay & the Americans"),
    ("Bob Seger System", "Bob Seger"),
    ("The Supremes & The Temptations", "The Supremes"),
    ("Gladys Knight & the Pips", "Gladys Knight"),
    (
        "Dionne and Friends (Dionne Warwick, Gladys Knight, Elton John and Stevie Wonder)",
        "Gladys Knight",
    ),
    ("Paul Stookey", "Peter Paul And Mary"),
    ("Sinéad O'Connor", "sineadoconnor"),
    ("Pras Michel featuring Ol' Dirty Bastard and Mýa", "Pras"),
    ("Missy Elliott", "Missy 'Misdemeanor' Elliott"),
    ("Beyoncé", "Beyonce Knowles"),
    ("The Game featuring 50 Cent", "Game"),
    ("Lil Jon featuring Usher and Ludacris", "Lil Jon & The East Side Boyz"),
    ("The Game featuring Lil Wayne", "Game"),
    ("Soulja Boy Tell 'Em", "Soulja Boy"),
    ("Eminem, Dr. Dre and 50 Cent", "Eminem"),
    ("Kesha", "Keha"),
    ("Kanye West, Big Sean, Pusha T and 2 Chainz", "Kanye West"),
    ("Snoop Dogg and Wiz Khalifa featuring Bruno Mars", "Snoop Dogg"),
    ("The Script featuring will.i.am", "Script"),
    ("Emeli Sandé", "Emeli Sand"),
    ("DJ Snake and Lil Jon", "DJ Snake"),
    ("A Great Big World and Christina Aguilera", "A Great Big World"),
    ("Jessie J, Ariana Grande, and Nicki Minaj", "Jessie J"),
    ("Miranda Lambert and Carrie Underwood", "Miranda Lambert"),
    ("Drake and Future", "Drake"),
    ("Zara Larsson and MNEK", "Zara Larsson"),
    ("The Weeknd featuring Daft Punk", "The Weeknd"),
    (
        "Lil Wayne, Wiz Khalifa and Imagine Dragons with Logic and Ty Dolla $ign featuring X Ambassadors",
        "Lil Wayne",
    ),
    ("Major Lazer and DJ Snake featuring MØ", "Major Lazer"),
    ("Shawn Mendes and Camila Cabello", "Shawn Mendes"),
    ("Seals and Crofts", "Seals Crofts"),
    ("A Boogie wit da Hoodie featuring Kodak Black", "Boogie wit da Hoodie"),
    ("Hailee Steinfeld and Grey featuring Zedd", "Hailee Steinfeld"),
]

# Artist branches in order, as (test pattern, pattern to cut); the first hit wins.
ARTIST_BRANCHES = [
    (" Featuring ", "(?s) Featuring .*"),
    (" featuring ", "(?s) featuring .*"),
    (" with ", "(?s) with .*"),
    ("The", "The "),
    ("&", "&"),
    ("-", "-"),
    (" x ", "(?s) x .*"),
    (" + ", "(?s) + .*"),
]
# Fixed value: the last branch when its plus sign is read as a character, not as "one or more".
ARTIST_PLUS_LITERAL = (r" \+ ", r"(?s) \+ .*")
# Fixed value: characters removed from every artist key at the end.
ARTIST_STRIP = " .,!+'"

# Topic-model settings and document-term bounds.
TOPICS_ALL = 20
TOPICS_SUBSET = 10
TOPIC_ALPHA = 50 / 20
TOPIC_DELTA = 0.1
TOPIC_SEED = 980
MIN_DOC_SHARE = 0.01
MAX_DOC_SHARE = 0.9

# Classifier settings.
TRAIN_SHARE = 0.75
SPLIT_SEED = 123
CV_FOLDS = 10
CV_REPEATS = 3

# Axis bounds of the sentiment distributions and cut-offs of the extreme songs.
SENTIMENT_AXIS = (-0.2, 0.8)
EXTREME_SENTIMENT = 0.35
