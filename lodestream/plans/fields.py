"""One query for each rule of field extraction and canonical form (SURVEY X, C, H, G, SG).

A rule is a few patterns over whole columns, stated once for Spark and for SQL (see dual).
"""

from __future__ import annotations

from lodestream.plans.dual import (
    at_most, case, col, distinct, empty_is_null, every, first, glued, greatest_in, group, hits, joined, ladder, least_in, lower, matches, number, numbers, of, only_one, parts, register, replaced, size, text_of_number, that,
    trimmed, whole, without,
)

DEMANDS, MAILS, STORED = "final_corrected_requirements", "outlook_messages", "metaforge_requirements"
N = r"([0-9]{1,2}(?:\.[0-9])?)"
body, subject, graph_id, job_id = col("body_plain"), col("subject"), col("graph_id"), col("job_id")
years, level, skills, mode = col("overall_experience"), col("experience_level"), col("mandatory_skills"), col("work_mode")
both = glued(first(subject, ""), " ", first(body, ""))

# --- years of experience

low, high = (number(group(years, rf"{N} *(?:-|–|to) *{N}", k)) for k in (1, 2))
one = number(group(years, N))
register("experience_digits", DEMANDS, "X2, X2b: years as (low, high); a single figure leaves high open, or fills both.",
         {"text": years, "low": first(low, one), "high": high, "high_or_same": first(high, one)}, years.there())

least = first(number(group(years, rf"{N} *\+")), number(group(years, rf"(?i)(?:min|minimum|at least|above|over)[a-z ]* {N}")))
most = number(group(years, rf"(?i)(?:max|maximum|up ?to|below|under)[a-z ]* {N}"))
register("experience_bounds", DEMANDS, "X2c: least and most years by words and signs: '8+', 'min 3', 'up to 5', '3-5', '4'.",
         {"text": years, "least": case((low.there(), low), (least.there(), least), (most.there(), None), default=one), "most": case((low.there(), high), (least.there(), None), default=most)}, years.there())

RANGE, PLUS = r"(?i)[0-9]{1,2} *(?:-|–|to) *([0-9]{1,2}) *(?:years?|yrs?)", r"(?i)([0-9]{1,2}) *\+ *(?:years?|yrs?)"
tops, pluses = greatest_in(numbers(every(body, RANGE, 1))), greatest_in(numbers(every(body, PLUS, 1)))
register("experience_conflicts", MAILS, "X6: where a mail states ranges and 'N+' the larger decides, a range on ties, with the reason.",
         {"graph_id": graph_id, "top_of_ranges": tops, "top_of_pluses": pluses, "reason": case((tops.there() & (pluses.null() | (tops >= first(pluses, 0))), "range"), (pluses.there(), "plus"), default="none")}, matches(body, RANGE) | matches(body, PLUS))

lows = numbers(every(body, r"(?i)([0-9]{1,2}) *(?:-|–|to) *[0-9]{1,2} *(?:years?|yrs?)", 1))
register("experience_in_bodies", MAILS, "X15, H48, H38: least and most years over all ranges of a mail, and the first as it stands.",
         {"graph_id": graph_id, "least": least_in(lows), "most": tops, "first_range": group(body, r"(?i)([0-9]{1,2} *(?:-|–|to) *[0-9]{1,2} *(?:years?|yrs?))")}, matches(body, RANGE))

register("experience_normal_form", DEMANDS, "C23: one notation of years: '3-5 years', '8+ years', '4 years'.",
         {"text": years, "form": case((low.there() & high.there(), glued(text_of_number(low), "-", text_of_number(high), " years")), (least.there(), glued(text_of_number(least), "+ years")), (one.there(), glued(text_of_number(one), " years")))}, years.there())

mentions = distinct(every(lower(body), r"[0-9]{1,2} *(?:\+|-|–|to)? *[0-9]{0,2} *(?:years?|yrs?)", 0))
register("experience_mentions", MAILS, "SG14: all mentions of years in a mail, each once in its order; the list shows thirty.", {"graph_id": graph_id, "n": size(mentions), "mentions": joined(at_most(mentions, 30))}, matches(body, r"(?i)[0-9] *(?:years?|yrs?)"))

start = first(low, least, one)
register("level_from_years", DEMANDS, "C6b, C6c, H13, H14: levels by the middle of the range and by its beginning.",
         {"text": years, "by_middle": case((start.null(), None), ((start + first(high, start)) >= 24, "Principal"), ((start + first(high, start)) >= 16, "Lead"), ((start + first(high, start)) >= 10, "Senior"), ((start + first(high, start)) >= 4, "Mid"), default="Junior"),
          "by_start": case((start.null(), None), (start < 3, "Junior"), (start < 7, "Mid"), default="Senior"), "by_ends": case((start >= 8, "Senior"), (start <= 3, "Junior"), (start.there(), "Mid"))}, years.there())

LEVELS = [(r"(?i)\b(principal|architect|expert)\b", "Principal"), (r"(?i)\b(lead|manager|head)\b", "Lead"), (r"(?i)\b(senior|sr\.?|experienced)(\b|$)", "Senior"), (r"(?i)\b(mid|middle|intermediate|associate)\b", "Mid"), (r"(?i)\b(junior|jr\.?|fresher|entry|trainee|intern)(\b|$)", "Junior")]
register("level_vocabulary", DEMANDS, "C6, H12, H18: typed levels as one of five words.", {"text": level, "level": ladder(level, LEVELS)}, level.there())
RANGES = [(r"(?i)\bprincipal\b", "12+ years"), (r"(?i)\blead\b", "8-12 years"), (r"(?i)\bsenior\b", "5-8 years"), (r"(?i)\bmid\b", "2-5 years"), (r"(?i)\bjunior\b", "0-2 years")]
register("range_from_level", DEMANDS, "H15: years as stated, else those that the level stands for.", {"job_id": job_id, "years": first(group(years, r"([0-9]{1,2} *(?:-|–|to) *[0-9]{1,2})"), ladder(ladder(level, LEVELS), RANGES))})

# --- employment, place of work, urgency, notice

EMPLOYED = [(r"(?i)contract.?to.?hire|c2h", "Contract to hire"), (r"(?i)full.?time|permanent|fte|regular", "Full time"), (r"(?i)part.?time", "Part time"), (r"(?i)contract|c2c|temporary", "Contract"), (r"(?i)intern", "Internship"), (r"(?i)freelance|consultant", "Freelance")]
employment = col("employment_type")
register("employment_vocabulary", DEMANDS, "C4, H17: typed forms of employment as one of six.", {"text": employment, "employment": ladder(employment, EMPLOYED)}, employment.there())
register("employment_keywords", MAILS, "C4b, H42: the form of employment that a mail's words name, full time where they name none.", {"graph_id": graph_id, "employment": ladder(both, EMPLOYED, "Full time"), "named": matches(both, "|".join(p for p, _ in EMPLOYED).replace("(?i)", "").join(("(?i)(?:", ")")))})

MODES = [(r"(?i)remote|work from home|\bwfh\b", "Remote"), (r"(?i)hybrid", "Hybrid"), (r"(?i)on.?site|\bwfo\b|office", "Onsite")]
register("work_mode_strict", DEMANDS, "X4, C5, H24: the place of work if just one is named.", {"text": mode, "mode": only_one(mode, MODES), "named": hits(mode, [p for p, _ in MODES])}, mode.there())
register("work_mode_in_bodies", MAILS, "C5b, H43: the place of work by a mail's words, hybrid before others.", {"graph_id": graph_id, "mode": ladder(both, [MODES[1], MODES[0], MODES[2]]), "named": hits(both, [p for p, _ in MODES])})

priority = col("priority")
URGENT = [(r"(?i)\b(high|urgent|critical|p1|top)\b", "HIGH"), (r"(?i)\b(medium|normal|p2)\b", "MEDIUM"), (r"(?i)\b(low|p3)\b", "LOW")]
register("priority_words", DEMANDS, "X31, C7, H11: typed urgency as one of three, by synonyms and by the whole word alone.", {"text": priority, "by_words": ladder(priority, URGENT), "whole_word": ladder(priority, [(rf"(?i)\b{x}\b", x) for x in ("HIGH", "MEDIUM", "LOW")])}, priority.there())
register("urgency_in_mails", MAILS, "H44: a mail's urgency by its words, medium where it has none.", {"graph_id": graph_id, "urgency": case((matches(both, r"(?i)\b(urgent|urgently|immediate|asap|critical)\b"), "High"), (matches(both, r"(?i)\b(no hurry|low priority|not urgent)\b"), "Low"), default="Medium")})

notice = col("notice_period")
register("notice_forms", DEMANDS, "X34, C31, H40: notice as days, immediate, serving or a last day; other text is null.",
         {"text": notice, "form": case((matches(notice, r"(?i)immediate"), "Immediate"), (matches(notice, r"(?i)serving"), "Serving notice"), (matches(notice, r"(?i)\b(lwd|last (working )?day)\b"), "Last working day"), (matches(notice, r"(?i)[0-9]{1,3} *days?"), "Days"), (matches(notice, r"(?i)[0-9]{1,2} *months?"), "Months")),
          "days": whole(first(number(group(notice, r"(?i)([0-9]{1,3}) *days?")), case((matches(notice, r"(?i)immediate"), 0.0)))), "most_days": whole(greatest_in(numbers(every(notice, r"([0-9]{1,3})", 1))))}, notice.there())

budget = first(col("yearly_budget"), col("monthly_budget"))
register("currency_codes", DEMANDS, "X30: the currency of a stated amount by sign or code, in fixed order.", {"text": budget, "currency": ladder(budget, [(r"(?i)₹|\b(inr|rs\.?|rupees?)(\b|[0-9 ])|lakh|lpa", "INR"), (r"(?i)\$|\busd\b|dollar", "USD"), (r"(?i)€|\beur\b|euro", "EUR"), (r"(?i)£|\bgbp\b|pound", "GBP")])}, budget.there())
register("budget_units", DEMANDS, "C27, C34: scale and period that stand beside an amount.", {"text": budget, "scale": ladder(budget, [(r"(?i)crore|\bcr\b", "crore"), (r"(?i)lakh|lac\b|lpa|\bl\b", "lakh"), (r"(?i)[0-9] *k\b|thousand", "thousand")]), "period": ladder(budget, [(r"(?i)lpa|annum|annual|year|p\.?a\b", "year"), (r"(?i)month|p\.?m\b|lpm", "month"), (r"(?i)day|daily", "day"), (r"(?i)hour|/hr|hourly", "hour")])}, budget.there())
register("engagement_terms", MAILS, "X33: the kind and the length of an engagement that a mail names.", {"graph_id": graph_id, "kind": ladder(body, EMPLOYED), "months": whole(number(group(body, r"(?i)([0-9]{1,2})[ -]*months?\b"))), "flexible": matches(body, r"(?i)\b(flexible|extend(able|ed)?|extension)\b")}, matches(body, r"(?i)contract|months?\b"))

# --- skills

SPLIT = r"[,;/|\n•*]+"
tokens = distinct(parts(skills, SPLIT))
register("skill_lists", DEMANDS, "C3, C37: text as a list at its marks, placeholders left out.", {"text": skills, "n": size(that(parts(skills, r"[,\n;/|]+"), r"^(n/a|na|nil|none|null|-+|tbd|unknown)$", False)), "items": joined(that(parts(skills, r"[,\n;/|]+"), r"^(n/a|na|nil|none|null|-+|tbd|unknown)$", False))}, skills.there())
register("skill_sets", DEMANDS, "C9, H34, S17: skills as a set, each once in the order of first place.", {"text": skills, "n": size(tokens), "skills": joined(tokens)}, skills.there())
WORDS = r"(?i) +and +| *& *|[,;|\n•*]+"
mandatory, other = distinct(parts(skills, WORDS)), distinct(parts(col("skills"), WORDS))
register("skill_tokens", DEMANDS, "X27, X28: mandatory skills also cut at 'and' and '&'; secondary ones are the others, without template headings.",
         {"job_id": job_id, "mandatory": joined(first(mandatory, mandatory)), "secondary": joined(that(without(other, first(mandatory, parts(of(""), WORDS))), r"^(good to have|nice to have|secondary|optional|skills?|others?)[ :.]*$", False))}, skills.there() & col("skills").there())
noise = [r"^[0-9 .+-]+$", r"(?i)^(name|email|phone|contact|total exp|relevant exp|current ctc|expected ctc|notice period|location|remarks?|s\.?no\.?|candidate)", r"(?i)\b(years?|months?|days?|lpa|regards|thanks)\b"]
register("skill_noise", DEMANDS, "G21, G22, G23: how many entries of a list are no skills, by figures, by columns of candidate tables, by words of terms, and by length.",
         {"text": skills, "figures": size(that(tokens, noise[0])), "columns": size(that(tokens, noise[1])), "terms": size(that(tokens, noise[2])), "long": size(that(tokens, r"^.{41,}$"))}, skills.there())
register("skills_cleaned", DEMANDS, "C32: skills without noise, empty lists are null.", {"text": skills, "skills": empty_is_null(joined(that(that(that(that(tokens, noise[0], False), noise[1], False), noise[2], False), r"^.{41,}$", False)))}, skills.there())
line = group(body, r"(?i)(?:^|\n)[ *>|-]*(?:must have skills|mandatory skills|key skills|tech stack|skills) *(?:[:=|]|- ) *([^\n\r]*[^\n\r ])")
register("skill_lines", MAILS, "X7: the labelled line of skills in a mail, cut into entries, slashes expanded.", {"graph_id": graph_id, "n": size(distinct(parts(line, SPLIT))), "skills": joined(distinct(parts(line, SPLIT)))}, line.there())
TECH = r"\b(?:java|javascript|python|react|angular|node|sql|aws|azure|gcp|sap|devops|salesforce|php|golang|ios|android|tableau|data|cloud|network|security|qa|test)\b"
register("subject_skills", MAILS, "X8: technical words of a subject, each once.", {"graph_id": graph_id, "n": size(distinct(every(lower(subject), TECH, 0))), "words": joined(distinct(every(lower(subject), TECH, 0)))}, matches(lower(subject), TECH))

# --- titles, places, ids

title = col("job_title")
clean = trimmed(replaced(replaced(replaced(title, r"(?i)^ *(urgent|re|fw|fwd|requirement|role|position) *[:|-]+ *", ""), r" *[|(\[].*$", ""), r"[ ,;:-]+$", ""))
register("title_cleanup", DEMANDS, "N14, H22: titles without marks of urgency, brackets and what follows bars, and the place after a dash.", {"text": title, "title": empty_is_null(clean), "after_dash": group(title, r" - ([A-Za-z][A-Za-z ]+)$")}, title.there())
location = col("location")
register("location_parts", DEMANDS, "H47, X32, SG13: a text of places cut at its marks, each once, of two letters or more, 'except' and 'remote' told.",
         {"text": location, "places": joined(that(distinct(parts(location, r"(?i)[,;/|&\n]+| or | and ")), r"^.{2,}$")), "n": size(that(distinct(parts(location, r"(?i)[,;/|&\n]+| or | and ")), r"^.{2,}$")), "is_remote": matches(location, r"(?i)^ *(remote|wfh|work from home) *$"), "all_except": group(location, r"(?i)\b(?:all|any|pan).*\bexcept +(.*[^ ])")}, location.there())
register("report_places", DEMANDS, "H39: the first four places of a text.", {"text": location, "places": joined(at_most(that(distinct(parts(location, r"(?i)[,;/|&\n]+| or | and ")), r"^.{2,}$"), 4))}, location.there())

number_text = col("client_jd_id")
REASONS = [(r"^[ #]*$", "empty"), (r"(?i)^ *(n/?a|nil|none|null|tbd|unknown|-+) *$", "placeholder"), (r"(?i)^[a-z ]+$", "words"), (r"^[ #]*[0-9]{1,2} *(-|to) *[0-9]{1,2}$", "range"), (r"^[ #]*[0-9]{4}-[0-9]{2}-[0-9]{2}$", "date"), (r"^[ #]*[0-9]{1,2}/[0-9]{1,2}/[0-9]{4}$", "date"), (r"^[ #+]*(91)?[6-9][0-9]{9}$", "phone"), (r"^[ #]*[1-9][0-9]{5}$", "pin"), (r"(?i)[0-9] *(years?|yrs?)\b", "experience"), (r"^[ #]*[0-9]{1,2}$", "count"), (r"(?i)[0-9] *(lpa|k|lakhs?)\b", "budget"), (r"^.{41,}$", "long")]
register("identifier_reasons", STORED, "C14, C16, E2, H53: an identifier with the first reason against it, and what is compared of it.", {"id": number_text, "reason": case((number_text.null(), "missing"), default=ladder(number_text, REASONS, "valid")), "clean": empty_is_null(replaced(first(number_text, ""), "[^A-Za-z0-9]", ""))})
lo, hi = (number(group(number_text, r"^[ #]*([0-9]{1,3}) *(?:-|to) *([0-9]{1,3})$", k)) for k in (1, 2))
register("identifier_ranges", STORED, "C15: identifiers that are ranges of numbers, low before high.", {"id": number_text, "low": lo, "high": hi, "is_range": first(lo < hi, False)}, number_text.there())
NEAR = r"(?i)(?:budget|ctc|rate|salary)[^\n]{0,40}\b([A-Z]{2,5}[-_ ]?[0-9]{4,})\b|\b([A-Z]{2,5}[-_ ]?[0-9]{4,})\b[^\n]{0,40}(?:budget|ctc|rate|salary)"
LABELLED = r"(?i)(?:req(?:uirement)?|job|jd|demand|position)[ _]*(?:id|no|number|#)?[ .:#-]*\b([A-Z]{2,5}[-_ ]?[0-9]{4,}|[0-9]{4,})\b"
register("identifier_context", MAILS, "C17, C18: whether an identifier stands near words of pay, and whether a label precedes one.", {"graph_id": graph_id, "near_pay": matches(body, NEAR), "labelled": group(both, LABELLED)}, matches(both, r"[0-9]{4,}"))
register("title_and_id", MAILS, "X14: title and id of a demand from a table row, else from labelled text.",
         {"graph_id": graph_id, "title": first(group(body, r"(?:^|\n)[>| ]*\|? *(?i:role|position|job title) *\| *([^|\n\r]*[^|\n\r ])"), group(body, r"(?i)(?:^|\n)[ *>|-]*(?:role|position|job title) *(?:[:=]|- ) *([^\n\r|]*[^\n\r| ])")), "id": first(group(body, r"(?:^|\n)[>| ]*\|? *(?i:req(?:uirement)? ?id|job id|demand) *\| *([A-Za-z0-9_/-]+)"), group(both, LABELLED))}, body.there())

# --- gates and signals on mails

sender = lower(col("from_email"))
REPORT = [r"(?i)\b(daily|weekly|monthly) (report|status|tracker)\b", r"(?i)\btracker\b", r"(?i)profiles? (shared|submitted|sent)", r"(?i)\b(cleared|rejected|shortlisted) *:? *[0-9]+", r"(?i)round: [0-9]+ of [0-9]+", r"(?i)\bsent: [0-9]+", r"(?i)interview (scheduled|status)", r"(?i)feedback (pending|awaited)"]
PROMOTION = [r"(?i)unsubscribe", r"(?i)newsletter", r"(?i)special offer", r"(?i)webinar", r"(?i)limited (time|seats)", r"(?i)click here", r"(?i)discount", r"(?i)view (this|in) (email|browser)"]
SEEKER = [r"(?i)\bmy (resume|cv|profile)\b", r"(?i)\b(i am|i'm) (looking|searching|interested|applying)", r"(?i)attached (is )?my\b", r"(?i)\bapply(ing)? for\b"]
CANDIDATE = [r"(?i)current ctc", r"(?i)expected ctc", r"(?i)total exp(erience)?", r"(?i)relevant exp(erience)?", r"(?i)current (company|employer|location)", r"(?i)candidate('s)? name"]
report, promotion, seeker, candidate = (hits(both, x) for x in (REPORT, PROMOTION, SEEKER, CANDIDATE))
register("report_gate", MAILS, "G7: status and tracker reports: two of eight marks, or the subject's.", {"graph_id": graph_id, "marks": report, "is_report": (report >= 2) | matches(subject, r"(?i)\b(status|tracker|daily|weekly) (report|list|update)\b|daily demand list")})
register("promotion_gate", MAILS, "G8: advertising: two marks, or one and a sender that advertises.", {"graph_id": graph_id, "marks": promotion, "is_promotion": (promotion >= 2) | ((promotion >= 1) & matches(sender, r"^(news|info|marketing|offers|noreply|no-reply)[^@]*@"))})
register("seeker_gate", MAILS, "G9, G14: mails of applicants and profiles of candidates, by their phrases.", {"graph_id": graph_id, "seeker": seeker, "candidate": candidate, "is_seeker": (seeker >= 2) | ((seeker >= 1) & col("has_attachments")), "is_profile": candidate >= 2})
reason = case((sender.null() | ~matches(sender, r"^[a-z0-9._%+-]+@[a-z0-9.-]+\.[a-z]{2,}$"), "malformed"), (report >= 2, "report"), (promotion >= 2, "promotion"), (seeker >= 2, "seeker"), (candidate >= 2, "profile"))
register("block_reasons", MAILS, "G10: the first reason to set a mail aside, null where there is none.", {"graph_id": graph_id, "reason": reason})
JD = [r"(?i)(?:^|\n)[ *>|-]*(role|position|job title)\b", r"(?i)(?:^|\n)[ *>|-]*(total )?exp(erience)?\b", r"(?i)(?:^|\n)[ *>|-]*(city|location|work location)\b", r"(?i)(?:^|\n)[ *>|-]*(openings|no\. of positions|count)\b", r"(?i)job description|responsibilities|what the person will do|key tasks", r"(?i)must have skills|mandatory skills|tech stack|skills", r"(?i)\bbudget\b", r"(?i)\b(notice|joining)\b"]
WISH = r"(?i)\b(we have an opening|please share|looking for|new demand|need(ed)?|requirement|hiring|sharing one more position)\b"
marks = hits(both, JD)
register("description_gate", MAILS, "G11, G3: a structured description: three marks, or two beside words of demand.", {"graph_id": graph_id, "marks": marks, "is_description": (marks >= 3) | ((marks >= 2) & matches(both, WISH))})
register("demand_gate", MAILS, "G12, H31: an obvious demand: words of demand, a title and a term, and no report.", {"graph_id": graph_id, "wish": matches(both, WISH), "is_demand": matches(both, WISH) & matches(both, JD[0]) & (hits(both, JD[1:]) >= 1) & (report < 2)})
register("mail_classes", MAILS, "G4, G13: one class for each mail with the mark that decided; a pluggable model may replace the last.", {"graph_id": graph_id, "class": case((reason.there(), "set aside"), (marks >= 3, "description"), (matches(both, WISH), "demand"), default="other"), "reason": first(reason, case((marks >= 3, "marks"), (matches(both, WISH), "wish")), "model")})
register("kept_records", DEMANDS, "G30: records with a title and at least one core field.", {"job_id": job_id, "core": hits(glued(first(years, "-"), "\n", first(skills, "-"), "\n", first(location, "-")), [r"[A-Za-z0-9]{2,}"]), "kept": matches(title, r"[A-Za-z]{2,}") & (matches(years, "[0-9]") | matches(skills, "[A-Za-z]") | matches(location, "[A-Za-z]"))})
HEADS = [r"(?i)\| *(role|position|job title) *\|", r"(?i)\| *(city|location|work location) *\|", r"(?i)\| *(exp|experience|total experience) *\|", r"(?i)\| *(count|openings|no\. of positions) *\|", r"(?i)\| *budget *\|", r"(?i)\| *(notice|joining) *\|", r"(?i)\| *shift *\|"]
register("table_gate", MAILS, "G19, H32: whether the headers of a demand table stand in a mail, three or more, and marks of a candidate table.", {"graph_id": graph_id, "headers": hits(body, HEADS), "is_table": hits(body, HEADS) >= 3, "candidate_marks": candidate}, body.there())
titles = distinct(every(body, r"(?i)(?:^|\n)[ *>|]*(?:role|position|job title) *(?:[:=|]|- ) *([^\n\r|]*[^\n\r| ])", 1))
register("many_demands_gate", MAILS, "G26, SG16: mails of several demands: two titles or words that say so.", {"graph_id": graph_id, "titles": size(titles), "first_titles": joined(at_most(titles, 3), " / "), "is_many": (size(titles) >= 2) | matches(both, r"(?i)\b(multiple|several|following) (positions|roles|requirements|openings)\b|daily demand list")}, body.there())
register("requirement_scores", MAILS, "G20: two points for each word of a demand, eight off where a candidate table stands.", {"graph_id": graph_id, "score": hits(both, JD) + hits(both, JD) - whole(case((candidate >= 2, 8), default=0))})

# --- lines of texts and reports

register("reported_roles", DEMANDS, "H37: the role of a report row: title, else what the subject names, else the subject.", {"job_id": job_id, "role": first(empty_is_null(clean), group(col("source_subject"), r"(?i)(?:requirement|urgent need|new demand [0-9]+|demand) *[:-] *(.*[^ ])"), col("source_subject"))})
register("reported_pay", DEMANDS, "H41: currency, yearly and monthly figures of a report row.", {"job_id": job_id, "currency": first(col("budget_currency"), "INR"), "yearly": number(replaced(group(col("yearly_budget"), r"([0-9][0-9,]*(?:\.[0-9]+)?)"), ",", "")), "monthly": number(replaced(group(col("monthly_budget"), r"([0-9][0-9,]*(?:\.[0-9]+)?)"), ",", ""))})
count = first(whole(col("number_of_positions")), whole(number(group(col("source_subject"), r"(?i)([0-9]{1,3}) *(?:positions|openings|seats)"))), whole(of(1)))
register("reported_positions", DEMANDS, "H45, H46, X3: positions by column, by subject, else one, and the kind of demand that makes.", {"job_id": job_id, "positions": count, "kind": case((count <= 1, "single"), (count <= 5, "multiple"), default="bulk")})
text = col("text")
register("label_lines", "documents", "H51, G24: how many lines are a label alone, and how many are protected by a technical word.", {"doc_id": col("doc_id"), "labels": size(every(text, r"(?:^|\n)[ \t]*[A-Z][A-Za-z ]{2,30}[:=-][ \t]*\r?(?:\n|$)", 0)), "technical": size(every(text, r"(?i)(?:^|\n)[^\n]{0,60}\b(?:api|sql|java|python|cloud|kubernetes|docker|linux|rest)\b", 0))}, text.there())
register("disclaimer_tails", "documents", "N18: where the first note of law begins, and the length of what stands before it.", {"doc_id": col("doc_id"), "head": size(parts(replaced(text, r"(?is)(?:^|\n)[^\n]{0,3}(?:disclaimer|confidentiality notice|important notice|this (?:e-?mail|message) (?:and|is)).*$", ""), r"\n")), "has_note": matches(text, r"(?i)(?:^|\n)[^\n]{0,3}(?:disclaimer|confidentiality notice|important notice|this (?:e-?mail|message) (?:and|is))")}, text.there())

monthly = number(replaced(group(col("monthly_budget"), r"([0-9][0-9,]*(?:\.[0-9]+)?)"), ",", ""))
register("monthly_pay", DEMANDS, "X5c: stated monthly figures that are plausible as such.", {"text": col("monthly_budget"), "figure": monthly, "plausible": first((monthly >= 10000) & (monthly <= 10000000), False)}, col("monthly_budget").there())
register("preprocessed_lines", MAILS, "N17: bodies without invisible characters, lone bullets joined with the next line.", {"graph_id": graph_id, "lines": size(parts(replaced(replaced(body, r"[\x{200B}\x{200C}\x{200D}\x{2060}\x{FEFF}]", ""), r"\n[ \t]*[•●◦*-][ \t]*\r?\n", "\n• "), r"\n")), "lone_bullets": size(every(body, r"\n[ \t]*[•●◦*-][ \t]*\r?\n", 0))}, body.there())
register("summaries", MAILS, "N19: at most 600 characters from the first phrase that states the wish on (a bounded summary).", {"graph_id": graph_id, "summary": group(body, r"(?is)\b((?:please find|please share|we have an opening|sharing one more|new demand).{0,580})")}, body.there())
ROW = r"(^|\n)[ >]*\|(?:[^|\n]*\|){4,}[ \r]*"
register("wide_rows_removed", MAILS, "N9, N12: bodies without the rows of candidate tables, which have four cells or more.", {"graph_id": graph_id, "rows": size(every(body, ROW, 0)), "left": size(parts(replaced(body, ROW, ""), r"\n"))}, body.there())
NEXT = r"(?i)(?:^|\n)[ \t]*(?:role|position|job title|location|city|experience|exp|openings|budget|skills|responsibilities|job description)[ \t]*:?[ \t]*\r?\n[ \t]*([^\n\r]+)"
register("next_line_values", "documents", "SG8, SG9: values that stand on the line below a lone label, as in vertical tables.", {"doc_id": col("doc_id"), "n": size(every(text, NEXT, 1)), "first_values": joined(at_most(every(text, NEXT, 1), 4), " / ")}, text.there())
