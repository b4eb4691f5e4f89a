"""Fixed values that must equal the source application's for equal results.

FIXED VALUES — stated as plain data, in the order the application uses them.
"""

# FIXED VALUES: text tokens read as missing by the CSV reader (pandas defaults).
NA_TOKENS = [
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan",
    "1.#IND", "1.#QNAN", "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a",
    "nan", "null",
]

# FIXED VALUES: declared layer layouts.
GOLD_FINAL_COLUMNS = [
    "student_id", "branch", "marks_10th", "marks_12th", "gender", "board_10th",
    "board_12th", "category", "gpa_1", "rank", "normalized_rank", "cgpa",
    "current_back", "ever_back", "gpa_2", "gpa_3", "gpa_4", "gpa_5", "gpa_6",
    "olympiads_qualified", "technical_projects", "tech_quiz", "engg_coaching",
    "ntse_scholarships", "miscellany_tech_events", "certification_course",
    "department", "heightcm", "weightkg", "10th_mark", "12th_mark",
    "college_mark", "hobbies", "daily_study_time", "prefer_to_study_in",
    "salary_expectation", "like_degree", "career_willingness",
    "social_media_time", "travelling_time_", "stress_level", "financial_status",
    "parttime_job", "age", "major", "study_hours_per_day", "social_media_hours",
    "netflix_hours", "part_time_job", "attendance_percentage", "sleep_hours",
    "diet_quality", "exercise_frequency", "parental_education_level",
    "internet_quality", "mental_health_rating", "extracurricular_participation",
    "previous_gpa", "semester", "dropout_risk", "social_activity", "screen_time",
    "study_environment", "access_to_tutoring", "family_income_range",
    "parental_support_level", "motivation_level", "exam_anxiety_score",
    "learning_style", "time_management_score", "exam_score",
]

BRONZE_RESEARCH_COLUMNS = [
    "branch", "marks_10th", "marks_12th", "gender", "board_10th", "board_12th",
    "category", "gpa_1", "rank", "normalized_rank", "cgpa", "current_back",
    "ever_back", "gpa_2", "gpa_3", "gpa_4", "gpa_5", "gpa_6",
    "olympiads_qualified", "technical_projects", "tech_quiz", "engg_coaching",
    "ntse_scholarships", "miscellany_tech_events",
]

BRONZE_ATTITUDE_COLUMNS = [
    "certification_course", "gender", "department", "heightcm", "weightkg",
    "10th_mark", "12th_mark", "college_mark", "hobbies", "daily_study_time",
    "prefer_to_study_in", "salary_expectation", "like_degree",
    "career_willingness", "social_media_time", "travelling_time_",
    "stress_level", "financial_status", "parttime_job",
]

BRONZE_PERFORMANCE_COLUMNS = [
    "student_id", "age", "gender", "major", "study_hours_per_day",
    "social_media_hours", "netflix_hours", "part_time_job",
    "attendance_percentage", "sleep_hours", "diet_quality",
    "exercise_frequency", "parental_education_level", "internet_quality",
    "mental_health_rating", "extracurricular_participation", "previous_gpa",
    "semester", "stress_level", "dropout_risk", "social_activity",
    "screen_time", "study_environment", "access_to_tutoring",
    "family_income_range", "parental_support_level", "motivation_level",
    "exam_anxiety_score", "learning_style", "time_management_score",
    "exam_score",
]

# FIXED VALUES: numeric coercion lists per source.
RESEARCH_NUMERIC = [
    "marks_10th", "marks_12th", "gpa_1", "gpa_2", "gpa_3", "gpa_4", "gpa_5",
    "gpa_6", "cgpa", "olympiads_qualified", "technical_projects", "tech_quiz",
    "engg_coaching", "ntse_scholarships", "miscellany_tech_events",
    "current_back", "ever_back", "rank", "normalized_rank",
]
ATTITUDE_NUMERIC = [
    "heightcm", "weightkg", "10th_mark", "12th_mark", "college_mark",
    "salary_expectation",
]
PERFORMANCE_NUMERIC = [
    "student_id", "age", "study_hours_per_day", "social_media_hours",
    "netflix_hours", "attendance_percentage", "sleep_hours",
    "exercise_frequency", "mental_health_rating", "previous_gpa", "semester",
    "stress_level", "social_activity", "screen_time", "parental_support_level",
    "motivation_level", "exam_anxiety_score", "time_management_score",
    "exam_score",
]
ATTITUDE_OUTLIER_COLUMNS = ["heightcm", "weightkg", "salary_expectation", "college_mark"]

# FIXED VALUES: attitude header renames after header normalisation.
ATTITUDE_RENAMES = {
    "daily_studing_time": "daily_study_time",
    "do_you_like_your_degree": "like_degree",
    "willingness_to_pursue_a_career_based_on_their_degree__": "career_willingness",
    "social_medai__video": "social_media_time",
    "stress_level_": "stress_level",
}
YES_NO_COLUMNS = ["certification_course", "like_degree", "parttime_job"]
TIME_RANGE_COLUMNS = ["daily_study_time", "social_media_time", "travelling_time_"]

# FIXED VALUES: free-text time ranges → bucket; rules in order, first match wins.
TIME_RANGE_RULES = [
    ("0-30_min", ["0 - 30", "30 minute"]),
    ("30-60_min", ["30 - 60", "1 - 1.30"]),
    ("1-2_hour", ["1 - 2", "1.30 - 2"]),
    ("2+_hour", ["more than 2", "2+"]),
]
TIME_RANGE_OTHER = "other"

# FIXED VALUES: board spellings → canonical board, 10th standard.
BOARD_10TH_MAPPING = {
    "BSEB Patna": "BSEB",
    "BSEB": "BSEB",
    "B.S.E.B": "BSEB",
    "BSEB PATNA": "BSEB",
    "B.S.E.B PATNA": "BSEB",
    "BIHAR SCHOOL EXAMINATION BOARD PATNA": "BSEB",
    "B.S.E.B.PATNA": "BSEB",
    "BIHAR SCHOOL EXAMINATION BOARD, PATNA": "BSEB",
    "B.S.E.B(PATNA)": "BSEB",
    "BIHAR SCHOOL EXAMINATION BOARD,PATNA": "BSEB",
    "Bihar School ExaminatiAon Board, Patna": "BSEB",
    "Bihar Shool Examination Board ,Patna": "BSEB",
    "bihar school examination board": "BSEB",
    "Bihar Board": "BSEB",
    "BIHAR BOARD": "BSEB",
    "CBSE": "CBSE",
    "C.B.S.E": "CBSE",
    "C.B.S.E.": "CBSE",
    "cbse": "CBSE",
    "CENTRAL BOARD OF SECONDARY EDUCATION": "CBSE",
    "CBSE BOARD": "CBSE",
    "Central Board of Secondary Education": "CBSE",
    "ICSE": "ICSE",
    "I.C.S.E": "ICSE",
    "ISCE": "ICSE",
    "I.C.S.E.": "ICSE",
    "i.c.s.e": "ICSE",
    "UP BOARD": "UP Board",
    "Uttar Pradesh Board": "UP Board",
    "U.P. BOARD": "UP Board",
    "Rajasthan Board": "RBSE",
    "RBSE": "RBSE",
    "RAJASTHAN BOARD": "RBSE",
    "BOARD OF SECONDARY EDUCATION,ANDHRA PRADESH": "Andhra Pradesh Board",
    "STATE BOARD OF ANDHRA PRADESH": "Andhra Pradesh Board",
    "Board of Secondary Education": "State Board",
    "MAHARASHTRA STATE BOARD OF SECONDARY EDUCATION": "Maharashtra State Board",
    "Maharashtra State Board": "Maharashtra State Board",
    "STATE BOARD": "State Board",
    "Haryana Board": "Haryana Board",
}

# FIXED VALUES: board spellings → canonical board, 12th standard.
BOARD_12TH_MAPPING = {
    "BSEB Patna": "BSEB",
    "CBSE": "CBSE",
    "ICSE": "ICSE",
    "C.B.S.E": "CBSE",
    "B.S.E.B": "BSEB",
    "BSEB": "BSEB",
    "I.S.C": "ICSE",
    "BSEB PATNA": "BSEB",
    "UP BOARD": "UP Board",
    "ISC": "ICSE",
    "I Sc": "ICSE",
    "cbse": "CBSE",
    "C.B.S.E.": "CBSE",
    "NIOS BOARD": "NIOS",
    "state": "State Board",
    "BOARD OF INTERMEDIATE EDUCATION,ANDHRA PRADESH": "Andhra Pradesh Board",
    "Central Board": "CBSE",
    "bhopal": "Other",
    "CENTRAL BOARD OF SECONDARY EDUCATION": "CBSE",
    "NIOS": "NIOS",
    "CBSE BOARD": "CBSE",
    "B.S.E.B.PATNA": "BSEB",
    "Board of Intermediate Education Andhra Pradesh": "Andhra Pradesh Board",
    "INTERMEDIATE BOARD OF EDUCATION- ANDHRA PRADESH": "Andhra Pradesh Board",
    "BIHAR SCHOOL EXAMINATION BOARD, PATNA": "BSEB",
    "Boar of Intermediate Education, A.P.": "Andhra Pradesh Board",
    "STATE BOARD": "State Board",
    "STATE BOARD OF ANDHRA PRADESH": "Andhra Pradesh Board",
    "B.S.E.B(H.S.PATNA)": "BSEB",
    "Maharashtra State Board": "Maharashtra State Board",
    "bihar school examination board": "BSEB",
    "BIHAR SCHOOL EXAMINATION BOARD,PATNA": "BSEB",
    "BIHAR BOARD": "BSEB",
    "Bihar School ExaminatiAon Board, Patna": "BSEB",
    "Bihar School Examination Board ,Patna": "BSEB",
    "Central Board of Secondary Education": "CBSE",
    "RBSE": "RBSE",
    "ANDHRA PRADESH BOARD": "Andhra Pradesh Board",
    "ISCE": "ICSE",
    "c.b.s.e": "CBSE",
    "RAJASTHAN BOARD": "RBSE",
    "Goa Board for Secondary and Higher Secondary Education": "Goa Board",
    "U.P. BOARD": "UP Board",
    "Bihar Board": "BSEB",
    "CBSE Board": "CBSE",
    "BOARD OF SECONDARY EDUCATION, RAJASTHAN": "RBSE",
    "H.S.E.B": "State Board",
}

# FIXED VALUES: ordinal score maps and their defaults.
TIME_SCORE = {"0-30_min": 1, "30-60_min": 2, "1-2_hour": 3, "2+_hour": 4, "other": 2}
STRESS_SCORE = {"fabulous": 0, "good": 1, "bad": 3, "awful": 4}
YES_NO_SCORE = {"yes": 1, "no": 0}
FINANCIAL_SCORE = {"awful": 1, "bad": 2, "good": 3, "fabulous": 4}
TIME_SCORE_DEFAULT = 2
STRESS_SCORE_DEFAULT = 2
YES_NO_DEFAULT = 0
FINANCIAL_DEFAULT = 2

# FIXED VALUES: study-time label → hours (notebook mapping; unmapped → NULL).
STUDY_HOURS = {
    "0 - 30 minute": 0.25,
    "30 - 60 minute": 0.75,
    "1 - 2 hour": 1.5,
    "2 - 3 hour": 2.5,
    "3 - 4 hour": 3.5,
    "more than 4 hour": 4.5,
}

# FIXED VALUES: career path rules, first match wins.
CAREER_RULES = [
    ("technical", "technical_projects", 2),
    ("academic", "gpa_1", 8),
    ("business", "career_willingness", 70),
]
CAREER_DEFAULT = "balanced"

# FIXED VALUES: support-need risk bands, right-closed (-inf,1], (1,4], (4,inf).
RISK_BANDS = [("low", None, 1.0), ("medium", 1.0, 4.0), ("high", 4.0, None)]

# FIXED VALUES: probability bands for classifier output.
PROBABILITY_BANDS = [(0.7, "High Risk", "Immediate mentor follow-up"),
                     (0.4, "Medium Risk", "Monitor and counsel")]
PROBABILITY_BAND_DEFAULT = ("No Risk", "Routine monitoring")

# FIXED VALUES: threshold sweep 0.20, 0.22, ... below 0.81 (31 values), default 0.5.
THRESHOLD_START = 0.2
THRESHOLD_STOP = 0.81
THRESHOLD_STEP = 0.02
THRESHOLD_DEFAULT = 0.5

# FIXED VALUES: readiness score weights and cut-offs.
READINESS_WEIGHTS = {"cgpa": 10 * 0.4, "internships": 0.3 * 10,
                     "projects": 0.2 * 10, "skills": 0.1 * 10}
READINESS_LEVELS = [(70, "Ready"), (40, "Moderate")]
READINESS_DEFAULT = "Needs Improvement"

# FIXED VALUES: dashboard alias groups (target ← first existing candidate).
ALIAS_GROUPS = {
    "current_back": ["current_back", "noofbacklog", "current_backlog", "total_backlogs"],
    "noofbacklog": ["noofbacklog", "current_back", "current_backlog", "total_backlogs"],
    "ever_back": ["ever_back", "history_of_backlogs", "backlog_history"],
    "stress_level": ["stress_level", "stresslevel", "stress"],
    "daily_study_time": ["daily_study_time", "study_time"],
    "social_media_time": ["social_media_time", "social_media_usage"],
}

# FIXED VALUES: dashboard defaults for absent columns (None = missing).
DASHBOARD_DEFAULTS = {
    "current_back": 0,
    "noofbacklog": None,
    "ever_back": 0,
    "attendance_percentage": 0,
    "study_hours_per_day": 0,
    "social_media_hours": 0,
    "exam_score": None,
    "gpa_1": None,
    "gpa_6": None,
    "semester": 1,
    "stress_level": "good",
    "daily_study_time": "other",
    "social_media_time": "other",
    "cgpa": None,
    "gender": "Unknown",
    "branch": "Unknown",
    "category": "GEN",
    "diet_quality": "average",
    "technical_projects": 0,
    "tech_quiz": 0,
    "certification_course": "no",
    "exam_anxiety_score": 0,
    "mental_health_rating": 0,
    "screen_time": 0,
    "exercise_frequency": 0,
}
# FIXED VALUES: names of the backlog count in uploaded tables, in order of preference.
UPLOAD_BACKLOG_NAMES = ["no_of_backlog", "backlogs"]
# FIXED VALUES: defaults of columns absent from an uploaded table (None = missing).
UPLOAD_DEFAULTS = {
    "attendance_percentage": 0,
    "study_hours_per_day": 0,
    "social_media_hours": 0,
    "exam_score": None,
    "gpa_1": None,
    "gpa_6": None,
    "exam_anxiety_score": 0,
    "mental_health_rating": 0,
    "screen_time": 0,
    "exercise_frequency": 0,
}
DASHBOARD_NUMERIC = [
    "study_hours_per_day", "attendance_percentage", "social_media_hours",
    "exam_anxiety_score", "mental_health_rating", "screen_time",
    "exercise_frequency", "current_back", "ever_back",
]

# FIXED VALUES: star schema column lists.
DIM_STUDENT = ["student_id", "gender", "branch", "category", "department",
               "heightcm", "weightkg", "financial_status", "parttime_job"]
DIM_ACADEMIC_HISTORY = ["student_id", "marks_10th", "marks_12th", "board_10th",
                        "board_12th", "gpa_1", "gpa_2", "gpa_3", "gpa_4", "gpa_5",
                        "gpa_6", "cgpa", "rank", "normalized_rank"]
DIM_STUDENT_ACTIVITY = ["student_id", "technical_projects", "tech_quiz",
                        "olympiads_qualified", "certification_course",
                        "ntse_scholarships", "miscellany_tech_events", "engg_coaching"]
DIM_BEHAVIOR = ["student_id", "daily_study_time", "prefer_to_study_in",
                "social_media_time", "travelling_time_", "stress_level", "hobbies",
                "like_degree", "career_willingness", "salary_expectation"]
DIM_SUBJECT = ["subjectid", "subjectname", "theorycredit", "practicalcredit"]
FACT_STUDENT_ACADEMIC = ["student_id", "semester", "subjectid",
                         "theoryagggradepoint", "theorycredit",
                         "practicalagggradepoint", "practicalcredit", "sgpa",
                         "prsgpa", "prcgpa", "noofbacklog", "thispresent",
                         "prispresent"]

# FIXED VALUES: detail mart and grouped marts (source column, output alias).
STUDENT_OVERVIEW_COLUMNS = [
    "student_id", "branch", "department", "gender", "career_path", "cgpa",
    "sgpa", "noofbacklog", "academic_score", "technical_score",
    "engagement_score", "stress_risk", "productivity_score", "bmi",
    "student_support_need", "employability_signal",
]
CAREER_SUMMARY_MEANS = [("cgpa", "avg_cgpa"), ("academic_score", "avg_academic_score"),
                        ("technical_score", "avg_technical_score"),
                        ("employability_signal", "avg_employability_signal")]
SEMESTER_SUMMARY_MEANS = [("sgpa", "avg_sgpa"), ("prsgpa", "avg_prsgpa"),
                          ("prcgpa", "avg_prcgpa"), ("noofbacklog", "avg_backlog"),
                          ("attendance_score", "avg_attendance_score"),
                          ("exam_score", "avg_exam_score"), ("cgpa", "avg_cgpa")]
BRANCH_SUMMARY_MEANS = [("cgpa", "avg_cgpa"), ("stress_risk", "avg_stress_risk"),
                        ("productivity_score", "avg_productivity"),
                        ("student_support_need", "avg_support_need"),
                        ("exam_score", "avg_exam_score")]
KPI_MEANS = [("cgpa", "avg_cgpa"), ("sgpa", "avg_sgpa"),
             ("academic_score", "avg_academic_score"),
             ("technical_score", "avg_technical_score"),
             ("stress_risk", "avg_stress_risk")]

# FIXED VALUES: classifier feature lists.
BACKLOG_BASE_FEATURES = [
    "semester", "subjectid", "theoryagggradepoint", "theorycredit",
    "practicalagggradepoint", "practicalcredit", "sgpa", "prsgpa", "prcgpa",
    "cgpa", "gpa_1", "gpa_2", "gpa_3", "gpa_4", "gpa_5", "gpa_6", "marks_12th",
    "thispresent", "prispresent", "daily_study_time", "stress_level",
    "social_media_time", "travelling_time_",
]
BACKLOG_ENGINEERED_FEATURES = [
    "academic_score", "attendance_score", "stress_risk", "productivity_score",
    "avg_gpa", "gpa_variance", "gpa_trend", "academic_momentum",
    "credit_efficiency", "subject_load", "wellbeing_balance",
    "employability_signal",
]
BACKLOG_ID_COLUMNS = ["student_id", "semester", "subjectid", "noofbacklog"]

BACKLOG_FEATURE_COLUMNS = BACKLOG_BASE_FEATURES + BACKLOG_ENGINEERED_FEATURES

# FIXED VALUES: regressor (and scoring request) inputs.
CGPA_FEATURES = [
    "marks_10th", "marks_12th", "current_back", "ever_back", "gender", "branch",
    "category", "study_hours_per_day", "attendance_percentage", "sleep_hours",
    "parental_support_level", "motivation_level", "exam_anxiety_score",
    "mental_health_rating", "social_media_hours", "screen_time",
    "exercise_frequency", "diet_quality",
]
CGPA_NUMERIC_FEATURES = [
    "marks_10th", "marks_12th", "current_back", "ever_back",
    "study_hours_per_day", "attendance_percentage", "sleep_hours",
    "parental_support_level", "motivation_level", "exam_anxiety_score",
    "mental_health_rating", "social_media_hours", "screen_time",
    "exercise_frequency",
]
CGPA_TARGET = "cgpa"
