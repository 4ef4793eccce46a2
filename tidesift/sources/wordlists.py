"""Fixed word tables: offline defaults for Indonesian short texts."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from tidesift.sources.local import local_frame

# Words that mark a text as Indonesian.
STRONG_WORDS = [
    "yg", "dgn", "nya", "jg", "juga", "ini", "itu", "dan", "atau", "untuk",
    "dengan", "ada", "tidak", "bisa", "aja", "gak", "ga", "gw", "aku",
    "kamu", "saya", "kalian", "kita", "mereka", "dia", "udah", "sudah",
    "jadi", "sih", "deh", "nih", "lah", "dong", "banget", "bgt",
]

# Informal spellings and their formal words.
WORD_MAP = {
    "gak": "tidak", "ga": "tidak", "udah": "sudah",
    "gimana": "bagaimana", "kalo": "kalau", "aja": "saja",
    "bgt": "banget", "yg": "yang", "dgn": "dengan",
    "tdk": "tidak", "blm": "belum", "sdh": "sudah",
    "krn": "karena", "utk": "untuk", "lg": "lagi",
    "emg": "memang", "ttp": "tetap", "hrs": "harus",
    "pake": "pakai", "pengen": "ingin", "kmrn": "kemarin",
    "abis": "habis", "bikin": "membuat", "nggak": "tidak",
}

# Words dropped from processed texts.
STOPWORDS = [
    "yg", "dgn", "nya", "jg", "juga", "ini", "itu", "dan", "atau", "untuk",
    "dengan", "ada", "tidak", "bisa", "aja", "gak", "ga", "gw", "aku",
    "kamu", "saya", "kalian", "kita", "mereka", "dia", "udah", "sudah",
    "jadi", "ya", "sih", "deh", "nih", "lah", "dong", "banget", "bgt",
    "wkwk", "haha", "lol", "wah", "oh", "ah", "eh", "hm",
    "rt", "amp", "via", "cc", "https", "http", "co", "www",
]

# Words that turn the sign of the next weighted word.
NEGATIONS = ["tidak", "gak", "ga", "nggak", "bukan", "kurang", "belum", "pernah"]

# Default sentiment lexicon.
POSITIVE = {
    "bagus": 3, "senang": 4, "hebat": 4, "cinta": 5, "setuju": 3, "baik": 3,
    "lolos": 4, "sukses": 4, "semangat": 4, "terima kasih": 5, "membantu": 3,
    "bangga": 4, "alhamdulillah": 5, "untung": 3, "mudah": 3, "menang": 4,
}
NEGATIVE = {
    "jelek": -3, "marah": -4, "benci": -5, "kecewa": -4, "gagal": -4,
    "susah": -3, "ribet": -3, "buruk": -3, "rugi": -3, "lemah": -2,
    "mahal": -2, "salah": -2, "mengecewakan": -5, "amburadul": -4,
}

# Weights that replace those of the lexicon.
OVERRIDES = {
    "lolos": 4, "bantu": 4, "membantu": 4, "benar": 2, "bangga": 4, "alhamdulillah": 5,
    "bagus": 4, "sukses": 4, "hebat": 4, "cinta": 5, "setuju": 3, "baik": 3,
    "semangat": 4, "terimakasih": 5, "untung": 3, "mudah": 3, "menang": 4,
    "bahagia": 4, "cocok": 3, "kuat": 3, "luar biasa": 4, "senang": 4,
    "gembira": 4, "puji": 3, "bersyukur": 5, "aman": 3, "damai": 3, "maju": 3,
    "pintar": 3, "cerdas": 4, "kreatif": 3,
    "kecewa": -4, "mengecewakan": -5, "ribet": -3, "buruk": -4, "jelek": -3,
    "gagal": -4, "susah": -3, "sulit": -3, "rugi": -3, "lemah": -2, "mahal": -2,
    "salah": -2, "benci": -5, "marah": -4, "amburadul": -4, "parah": -3,
    "payah": -3, "hancur": -4, "kacau": -4, "masalah": -3, "permasalahan": -3,
    "tuntut": -2, "tuntutan": -2, "sesal": -3, "menyesal": -3,
}

# Words taken out of the lexicon (weight 0).
NEUTRAL_WORDS = [
    "cukup", "anak", "jangan", "tidak", "gak", "ga", "nggak",
    "apa", "semua", "ikut", "kalau", "kalo", "kayak", "pilih",
    "kata", "masuk", "pajak", "sama", "punya", "buat", "bikin",
    "laku", "lakukan", "ada", "adalah", "yaitu", "merupakan",
    "menjadi", "jadi", "bisa", "dapat", "luar", "negeri",
    "dalam", "negara", "indonesia", "warga", "rakyat",
    "beasiswa", "awardee", "penerima", "penerimabeasiswa", "pendaftaran",
    "daftar", "seleksi", "syarat", "reguler", "kuota", "kuliah",
    "sekolah", "studi", "belajar", "pendidikan", "didik", "universitas",
    "kampus", "uras", "brain", "drain", "alumni", "lulusan",
    "video", "unggah", "posting", "cuitan", "tweet", "netizen",
    "warganet", "bapak", "ibu", "orang", "orangtua", "keluarga",
    "tahun", "bulan", "hari", "jam", "tanggal", "juni", "juli",
    "waktu", "kali", "dulu", "sekarang", "nanti", "besok",
    "kemarin", "lusa", "info", "bilang", "lanjut", "akhir", "batas",
    "sedia", "lengkap", "resmi", "buka", "banyak", "proses", "sangat",
    "sering", "pemberitahuan", "jelas", "dokumen", "admin", "adminnya",
    "ubah", "berubah", "pelamar", "lamar", "birokrasi",
]

# Root words that affix rules lead to: words of the lexicon and of everyday texts without affixes.
ROOTS = [
    "bantu", "benar", "bangga", "bagus", "sukses", "hebat", "cinta", "setuju", "baik", "semangat", "untung", "mudah",
    "menang", "bahagia", "cocok", "kuat", "senang", "gembira", "puji", "syukur", "aman", "damai", "maju", "pintar",
    "cerdas", "kreatif", "kecewa", "ribet", "buruk", "jelek", "gagal", "susah", "sulit", "rugi", "lemah", "mahal",
    "salah", "benci", "marah", "parah", "payah", "hancur", "kacau", "masalah", "tuntut", "sesal", "sekali", "suka",
    "ajar", "didik", "kerja", "makan", "minum", "main", "tulis", "baca", "lihat", "dengar", "bicara", "jalan", "lari",
    "duduk", "tidur", "bangun", "beli", "jual", "bayar", "pakai", "guna", "buat", "cari", "temu", "kirim", "terima",
    "beri", "ambil", "bawa", "simpan", "buka", "tutup", "masuk", "keluar", "datang", "pergi", "pulang", "tinggal",
    "hidup", "mati", "sakit", "sehat", "rumah", "sekolah", "kampus", "buku", "uang", "waktu", "orang", "anak", "kata",
    "nama", "tempat", "negara", "kota", "desa", "harga", "hasil", "mulai", "akhir", "ubah", "tambah", "kurang",
    "lebih", "besar", "kecil", "tinggi", "rendah", "panjang", "pendek", "cepat", "lambat", "baru", "lama", "muda",
    "tua", "dukung", "lindung", "tolong", "harap", "percaya", "rasa", "pikir", "tahu", "kenal", "ingat", "lupa",
    "tanya", "jawab", "sapu", "daftar", "luang", "usaha", "janji", "tunggu", "coba", "pilih", "milik", "warga",
]


def words_frame(spark: SparkSession, words) -> DataFrame:
    return local_frame(spark, [(w,) for w in words], "word string")


def map_frame(spark: SparkSession, mapping: dict[str, str]) -> DataFrame:
    return local_frame(spark, mapping.items(), "word string, formal string")


def lexicon_frame(spark: SparkSession, weights: dict[str, int]) -> DataFrame:
    return local_frame(spark, weights.items(), "word string, weight int")


def overrides_frame(spark: SparkSession) -> DataFrame:
    return lexicon_frame(spark, OVERRIDES | dict.fromkeys(NEUTRAL_WORDS, 0))
