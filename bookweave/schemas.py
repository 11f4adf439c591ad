"""Tables of the book model, and constants."""

from __future__ import annotations

#: What counts as open access, defaults and thresholds of the published data set.
PD_CODES = ("pd", "pdus", "cc-zero")
PD_ACCESS = "Full view"
SHINGLE_WIDTH = 7
HAS_TEXT_TOKENS = 100
MIN_LANGUAGE_TOKENS = 1000
TARGET_LLM = "default"

#: Types of a line of scanned text.
LINE_TYPES = (
    "UNKNOWN",
    "NOISE_OR_BROKEN_TEXT",
    "PAGE_NUMBER",
    "RUNNING_HEAD",
    "HEADING_OR_TITLE",
    "PARAGRAPH_CHUNK",
    "PARAGRAPH_END",
    "LOOSE_SENTENCE_OR_LIST_ITEM",
    "SEPARATOR",
)

TEXT_METRICS = "char_count long, char_count_continuous long, word_count long, word_count_unique long, word_type_token_ratio double, bigram_count long, bigram_count_unique long, bigram_type_token_ratio double, trigram_count long, trigram_count_unique long, trigram_type_token_ratio double, sentence_count long, sentence_count_unique long, sentence_type_token_ratio double, average_sentence_length double, tokenizability double"

TABLES = {
    "books": "barcode string, archive_is_available boolean, metadata_is_enriched boolean",
    "page_count": "barcode string, count_from_ocr int",
    "token_count": "barcode string, target_llm string, tokenizer string, count long",
    "year_of_publication": "barcode string, year int, decade int, century int, source_field string",
    "main_language": "barcode string, from_metadata_iso639_2b string, from_metadata_iso639_3 string, metadata_source string, from_detection_iso639_2b string, from_detection_iso639_3 string, detection_source string",
    "language_detection": "barcode string, iso639_2b string, iso639_3 string, token_count long, tokenizer string, percentage_of_total double, detection_source string",
    "topic_classification": "barcode string, from_metadata string, metadata_source string, from_detection string, detection_source string, detection_confidence double",
    "genre_classification": "barcode string, from_metadata string, metadata_source string",
    "ocr_quality": "barcode string, from_metadata int, metadata_source string, from_detection int, detection_source string",
    "scanned_text_simhash": "barcode string, hash string",
    "text_analysis": f"barcode string, {TEXT_METRICS}",
    "ocr_postprocessing_text_analysis": f"barcode string, {TEXT_METRICS}",
    "topic_classification_training_dataset": "barcode string, target_topic string, set string",
    "rights_determination": "barcode string, from_record string, htid string, rights_code string, reason_code string, last_update_year int, last_update_month int, last_update_day int, enumcron string, us_rights_string string, retrieved_date timestamp",
    "ocr_postprocessing_training_dataset": "barcode string, page_number int, total_pages int, line_number int, total_lines int, text string, target_type string, set string",
}

#: ISO 639-2 codes whose bibliographic form (key) differs from the terminological one.
BIBLIOGRAPHIC = {
    "alb": "sqi", "arm": "hye", "baq": "eus", "bur": "mya", "chi": "zho", "cze": "ces", "dut": "nld", "fre": "fra", "geo": "kat", "ger": "deu",
    "gre": "ell", "ice": "isl", "mac": "mkd", "mao": "mri", "may": "msa", "per": "fas", "rum": "ron", "slo": "slk", "tib": "bod", "wel": "cym",
}
