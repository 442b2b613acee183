"""Values that must be the same wherever these tables are read or graded."""

# --- Fixed values ------------------------------------------------------------

# Marker that opens and closes the reasoning part of a completion.
REASONING_MARKER = "½"

# Answer block: first opening tag, then the first closing tag after it; any case, across lines.
ANSWER_BLOCK = (
    r"\A[^<]*+(?:<(?!(?iu:answer)>)[^<]*+)*+<(?iu:answer)>"
    r"([^<]*+(?:<(?!/(?iu:answer)>)[^<]*+)*+)</(?iu:answer)>"
)

# Placeholder for the picture in a problem text.
IMAGE_TAG = "<image>"

# The characters that str.isspace() accepts.
WHITESPACE = (
    "\t\n\x0b\x0c\r\x1c\x1d\x1e\x1f \x85\xa0\u1680"
    "\u2000\u2001\u2002\u2003\u2004\u2005\u2006\u2007\u2008\u2009\u200a"
    "\u2028\u2029\u202f\u205f\u3000"
)

# The same characters as a class of a Java pattern.
WHITESPACE_CLASS = r"(?U)[\s\x1c-\x1f]"

# Calculator-style spelling of LaTeX: innermost fractions and roots, then single tokens in order.
INNER_FRACTION = r"\\frac\{([^{}]+)\}\{([^{}]+)\}"
INNER_ROOT = r"\\sqrt\{([^{}]+)\}"
EXPR_SPELLING = {"{": "(", "}": ")", "^": "**", "\\cdot": "*", "\\times": "*", "\\pi": "pi"}

# Rewards.
MARKER_REWARD = 0.05
ANSWER_BLOCK_REWARD = 0.05
FORMAT_BONUS = 0.1
CORRECT_ANSWER_BONUS = 1.0
ACCURACY_WEIGHT = 1.0
FORMAT_WEIGHT = 0.1
TOLERANCE = 1e-9

# Sizes.
SFT_SAMPLES = 500
EVAL_SAMPLES = 128
GENERATIONS = 4

# Sample ids.
SFT_ID = "sft_%05d"
RL_ID = "rl_%05d"

# Stand-in completion, used where no teacher completion exists.
NO_ANSWER = "N/A"
MOCK_COMPLETION = """½
Looking at this geometry problem, I need to analyze the given information and solve step by step.

Question: {question}

[This is a mock response for testing purposes.]

Based on my analysis, the answer is {answer}.
½

<answer>
{answer}
</answer>"""

# Teacher prompts.
TEACHER_SYSTEM_PROMPT = (
    "你是一个顶级的几何数学老师。你会被提供一张几何图片、一道问题，以及这道题的【最终标准答案】。\n"
    "你的任务是：根据图片和已知答案，倒推并写出极其详细、逻辑严密的解题步骤（思维链）。\n"
    "【严格格式要求】\n"
    "1. 你必须把所有的推理、计算过程包裹在 ½ 和 ½ 标签之间。\n"
    "2. 在思考过程结束后，必须另起一行，用 <answer> 和 </answer> 标签包裹那个我提供给你的最终答案。\n"
    "3. 绝对不要在标签之外输出任何多余的废话。"
)
TEACHER_USER_PROMPT = "题目：{question}\n已知正确答案是：{answer}\n请开始你的推演："

# --- End of fixed values -----------------------------------------------------

# Added to the spread of a group before dividing by it; a parameter wherever it is used.
ADVANTAGE_EPS = 1e-4
