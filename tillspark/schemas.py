"""Schemas of the data that flows between stages."""

ITEM = "struct<productName:string,itemCode:string,price:string,amount:string,category:string>"
RECEIPT = f"storeName string, storeAddress string, purchaseDate string, purchaseTime string, currency string, items array<{ITEM}>, totalItems int, subtotal string, tax string, total string, paymentMethod string"
FLAT_ITEM = "productName string, purchaseDate string, price string, amount string, storeName string, latitude double, longitude double"
OCR_TOKEN = "struct<idx:int,content:string,polygon:array<double>>"
OCR_PAGE = f"page_id string, page_no int, width double, height double, words array<{OCR_TOKEN}>, lines array<{OCR_TOKEN}>"
LOG_EVENT = (
    "time string, level string, service string, event string, trace_id string, user_id string, image_name string, error string, "
    "image_size_bytes bigint, ocr_provider string, ocr_latency_ms double, ocr_success boolean, pages int, chars_extracted bigint, cost_usd double, "
    "llm_provider string, llm_model string, llm_latency_ms double, llm_latency_source string, llm_input_tokens bigint, llm_output_tokens bigint, llm_input_chars bigint, "
    "llm_prompt_path string, llm_cost_usd double, llm_cost_source string, llm_success boolean, items_extracted bigint, "
    "usage struct<input_tokens:bigint,output_tokens:bigint,total_tokens:bigint>, cost struct<total_usd:double,source:string>, total_latency_ms double, success boolean, "
    "endpoint string, status int, latency_ms double, items_attempted bigint, items_uploaded bigint, items_deleted bigint, items_failed bigint"
)
