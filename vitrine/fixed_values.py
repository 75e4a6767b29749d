"""Fixed values.

Literals that the reference's models compare against, emit, or declare.  They
must stay equal to the reference's for the results to match, so they are
stated here once, plainly, and imported by the code that uses them.
"""

# --- fixed values: order statuses ---------------------------------------------------------
CANCELLED_STATUSES = ("annulée", "cancelled")       # lower-cased statuses excluded from revenue
STATUS_IN_TRANSIT = "en transit"                    # lower-cased
STATUS_CANCELLED = "annulée"                        # lower-cased

# --- fixed values: promotions -------------------------------------------------------------
PROMO_TYPE_FIXED = "Remise fixe"
PROMO_TYPE_PERCENT = "Pourcentage"

# --- fixed values: output labels ----------------------------------------------------------
UNSOLD_LABEL = "jamais_vendu"
LEAST_SOLD_LABEL = "moins_vendus"
AGE_BANDS = ((18, 25, "18-25"), (26, 35, "26-35"), (36, 45, "36-45"), (46, 60, "46-60"))
AGE_BAND_OTHER = "60+"
MONTH_STRONG, MONTH_WEAK, MONTH_NORMAL = "Mois fort", "Mois faible", "Normal"
MONTH_STRONG_FACTOR, MONTH_WEAK_FACTOR = "1.3", "0.7"
PERIOD_LABELS_7D = ("Avant promo", "Pendant promo", "Après promo")
PERIOD_OTHER_7D = "Hors période"
PERIOD_LABELS_30D = ("avant", "pendant", "apres")
PERIOD_OTHER_30D = "autre"
SENSITIVITY_HIGH, SENSITIVITY_LOW, SENSITIVITY_MID = ("Réagit très bien à la promo", "Insensible à la promo",
                                                       "Effet modéré")
SENSITIVITY_HIGH_AT, SENSITIVITY_LOW_AT = 0.3, 0.1
DAY_PROMO, DAY_NO_PROMO = "jour_promo", "jour_hors_promo"
SENTIMENTS = {"nb_positif": "positif", "nb_neutre": "neutre", "nb_negatif": "négatif"}
NO_COMPLAINT = "Aucune"
RESPONSE_UNKNOWN = "inconnu"
RESPONSE_BUCKETS = ((1, "≤ 1h"), (4, "1-4h"), (12, "4-12h"), (24, "12-24h"))
RESPONSE_OVER = "> 24h"
DELIVERY_LATE, DELIVERY_CANCELLED, DELIVERY_OK = "Retard probable", "Annulée", "Dans les délais ou terminée"
LATE_DELIVERY_COMMENT = "Delivery took too long."
BREAKDOWN_STATES = ("En panne", "En maintenance")
KEYWORDS_3 = {"nb_average_quality": "average quality", "nb_long": "long", "nb_damaged": "damaged"}
KEYWORDS_8 = {"nb_damaged": "damaged", "nb_very_happy": "very happy", "nb_delivery": "delivery",
              "nb_quality": "quality", "nb_product": "product", "nb_not_great": "not great",
              "nb_experience": "experience", "nb_service": "service"}
PEAK_SIGMAS = 2
MIN_REVIEWS_WORST = 5
MIN_REVIEWS_MONTH = 10
PROMO_WINDOW_7D, PROMO_WINDOW_30D = 7, 30
DECLINE_RUN = 5

# --- fixed values: calendar and ingest ----------------------------------------------------
CALENDAR_START, CALENDAR_END = "2019-01-01", "2025-08-05"
HEADER_PUNCTUATION = "’'\"/\\()[]{}:;,."             # each replaced by '_'
MISSING_MARKERS = ("#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA",
                   "NULL", "NaN", "None", "n/a", "nan", "null")  # fields that a CSV loader reads as missing
HEADER_ACCENTS = (("é", "e"), ("è", "e"), ("ê", "e"), ("â", "a"), ("ô", "o"))
